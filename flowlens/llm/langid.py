"""Operator 2: language identification with bit-sliced Bloom filters of character n-grams.

Training counts every n-gram of every labelled text per language. A language contains an n-gram
when its share of the language's n-grams is at least ``MIN_SHARE`` and at least ``RATIO`` of the
largest share in any language, so a language has at most 1/MIN_SHARE n-grams and the filter
has a proven size. The filters of all languages are stored bit-sliced: one table of masks with a bit
per language; the AND of an n-gram's ``HASHES`` masks names all languages that contain it at
once. A text's popcounts per language are corrected for the false-positive rate of that
language's filter, fill ** HASHES, and the largest corrected count decides.

N-grams are ``N`` consecutive characters of the lower-cased text in which runs of other characters
than letters are one blank; a blank stands only at an n-gram's ends.

Defined results: a null text or one without a letter is ``und`` with score 0; ties go to the
smaller language name; a text of which no language knows an n-gram goes to the language with
the most training n-grams, score 0; without training rows every text is ``und``; rows without
language train nothing; repeated rows count as often as they stand there; extra columns are not read.
Texts are handled whole, in blocks bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import cut

N = 3
HASHES = 3
SLOTS = 1 << 20
MIN_SHARE = 1e-5
RATIO = 0.1
FLUSH = 1 << 21
_U = np.uint64
_LETTER: list = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTER[0]


def grams(texts: pa.Array, n: int = N) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, n-gram hashes, row of each, whether each row has a letter)."""
    c = tb.seeded(2000 + n, n) | _U(1)
    for lo, hi, _, _ in tb.blocks(texts):
        part = pc.utf8_lower(texts.slice(lo, hi - lo).fill_null(""))
        length = np.asarray(pc.utf8_length(part)).astype(np.int64) + 2
        joined = " " + "  ".join(part.to_pylist()) + " "
        cp = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        row = np.repeat(np.arange(hi - lo), length)
        letter = _letters()[cp]
        keep = letter | np.r_[True, letter[:-1]]
        cp = np.where(letter, cp, 0)[keep].astype(np.uint64)
        letter, row = letter[keep], row[keep]
        has = np.bincount(row, weights=letter, minlength=hi - lo) > 0
        m = len(cp) - n + 1
        if m <= 0:
            yield lo, hi, np.zeros(0, np.uint64), np.zeros(0, np.int64), has
            continue
        ok = np.ones(m, dtype=bool)
        for j in range(1, n - 1):
            ok &= letter[j : j + m]
        with np.errstate(over="ignore"):
            h = cp[:m] * c[0]
            for j in range(1, n):
                h = h + cp[j : j + m] * c[j]
            yield lo, hi, tb.splitmix(h[ok]), row[1 : m + 1][ok], has


def _count(n: int):
    def out(store: dict) -> Iterator[pa.RecordBatch]:
        for lang, (g, c) in store.items():
            for lo in range(0, len(g), 200_000):
                s = slice(lo, lo + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g[s]), pa.string()), pa.array(g[s].view(np.int64)), pa.array(c[s])], names=["lang", "gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store: dict = {}
        for b in batches:
            langs = b.column("lang").to_pylist()
            for lo, hi, h, row, _ in grams(b.column("text"), n):
                mine = langs[lo:hi]
                for lang in set(mine):
                    pick = np.array([x == lang for x in mine])[row]
                    g, c = np.unique(h[pick], return_counts=True)
                    if lang in store:
                        g2, c2 = store[lang]
                        u, inv = np.unique(np.r_[g2, g], return_inverse=True)
                        g, c = u, np.bincount(inv, weights=np.r_[c2, c]).astype(np.int64)
                    store[lang] = (g, c.astype(np.int64))
                if sum(len(g) for g, _ in store.values()) > FLUSH:
                    yield from out(store)
                    store = {}
        yield from out(store)

    return run


def _places(h: np.ndarray, j: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (tb.splitmix(h + _U(j + 1) * _U(0x9E3779B97F4A7C15)) % _U(SLOTS)).astype(np.int64)


class LanguageFilter:
    """The bit-sliced table: ``table[word, slot]`` holds the bits of 63 languages."""

    def __init__(self, langs: list[str], totals: dict, rows: list):
        self.langs = langs
        self.table = np.zeros((max(1, -(-len(langs) // 63)), SLOTS), dtype=np.uint64)
        if rows:
            g, i = (np.array(x) for x in zip(*rows))
            g = g.astype(np.int64).view(np.uint64)
            for j in range(HASHES):
                for w in range(len(self.table)):
                    s = i // 63 == w
                    np.bitwise_or.at(self.table[w], _places(g[s], j), _U(1) << (i[s] % 63).astype(np.uint64))
        fill = [float(((self.table[i // 63] >> _U(i % 63)) & _U(1)).mean()) for i in range(len(langs))]
        self.false_rate = np.array([f**HASHES for f in fill])
        self.default = max(range(len(langs)), key=lambda i: (totals[langs[i]], -i)) if langs else None

    def masks(self, h: np.ndarray, word: int) -> np.ndarray:
        t = self.table[word]
        m = t[_places(h, 0)]
        for j in range(1, HASHES):
            m &= t[_places(h, j)]
        return m

    def decide(self, h: np.ndarray, row: np.ndarray, has: np.ndarray) -> tuple[list, np.ndarray]:
        n = np.bincount(row, minlength=len(has)).astype(float)
        k = len(self.langs)
        if not k:
            return ["und"] * len(has), np.zeros(len(has))
        value = np.zeros((k, len(has)))
        for w in range(len(self.table)):
            m = self.masks(h, w)
            for i in range(63 * w, min(k, 63 * w + 63)):
                hit = np.bincount(row, weights=(m >> _U(i % 63)) & _U(1), minlength=len(has))
                f = self.false_rate[i]
                value[i] = np.maximum(0.0, (hit - n * f) / (1 - f) if f < 1 else 0.0)
        total = value.sum(axis=0)
        best = np.where(total > 0, value.argmax(axis=0), self.default)
        score = np.where(total > 0, value.max(axis=0) / np.where(total > 0, total, 1), 0.0)
        lang = [self.langs[b] if ok else "und" for b, ok in zip(best.tolist(), has.tolist())]
        return lang, np.where(has, score, 0.0)


def fit_filters(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", n: int = N) -> LanguageFilter:
    """Learn from all rows with text and language."""
    train = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = cut(train.mapInArrow(_count(n), "lang string, gram bigint, c bigint").groupBy("lang", "gram").agg(F.sum("c").alias("c")))
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("c")).collect()}  # a row per language
    langs = sorted(totals)
    if not langs:
        return LanguageFilter([], {}, [])
    per = train.sparkSession.createDataFrame([(x, i, int(totals[x])) for i, x in enumerate(langs)], "lang string, i int, total bigint")
    share = counts.join(F.broadcast(per), "lang").withColumn("share", F.col("c") / F.col("total")).where(F.col("share") >= MIN_SHARE)
    top = share.groupBy("gram").agg(F.max("share").alias("top"))
    # at most languages / MIN_SHARE rows
    rows = share.join(top, "gram").where(F.col("share") >= RATIO * F.col("top")).select("gram", "i").toPandas()
    return LanguageFilter(langs, totals, list(zip(rows["gram"].tolist(), rows["i"].tolist())))


def predict(docs: DataFrame, model: LanguageFilter, text_col: str = "text", n: int = N) -> DataFrame:
    """docs + ``lang_pred``, ``score``; only the text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def judge(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            lang, score = [], []
            for _, _, h, row, has in grams(texts, n):
                a, b = shared.value.decide(h, row, has)
                lang += a
                score.append(b)
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))], names=["lang_pred", "score"])

    return docs.withColumn("_lang", judge(F.col(text_col))).select(*docs.columns, "_lang.lang_pred", "_lang.score")


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text modulo n; a row without id has remainder 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % n, F.lit(0))


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Learn from all folds but 0, predict every document."""
    d = docs.select("doc_id", "text", "lang")
    model = fit_filters(d.where(fold(F.col("doc_id"), folds) != 0))
    return predict(d.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")
