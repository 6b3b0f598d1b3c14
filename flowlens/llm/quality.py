"""Operator 8: quality rules with risk-controlled thresholds.

Every text gets a few badness scores. For each stratum (language) and score, the cutoff is
chosen from a fixed grid by exact binomial tests on the labelled documents: a cutoff is
certified when "it rejects more than its share of the good documents" can be refused at the
corrected level; the share is ``alpha`` divided by the number of the stratum's scores, as a document
goes when it exceeds any of the cutoffs. Inside one (stratum, score) the grid is walked from lenient to strict and
stops at the first failure (fixed-sequence testing, no correction needed); over strata and
scores the level is divided (Bonferroni). So with probability 1 - delta all cutoffs in force
in a stratum together falsely reject at most ``alpha`` of it. Among the certified cutoffs the one that rejects most
bad documents for its good ones is used, the lenient one on a tie. A stratum with too few
labelled documents has no certified cutoff and the method rejects nothing there.

Defined results: a null text counts as empty (no words, base_failed); a null language is a
stratum of its own; repeated rows are judged each alike; repeated labels count once per row
they join; an empty documents or labels table gives an empty result or no cutoffs; extra
columns pass through ``filter_quality`` untouched (helper columns start with ``_q8_``).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import cut

WINDOW = 5
ALPHA = 0.01
DELTA = 0.05
GOOD_COST = 10.0

#: cutoffs of the ratios in thousandths, lenient to strict (a document above the cutoff is rejected)
GRID = [900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 170, 140, 120, 100, 80, 65, 50, 40, 30, 20, 15, 10]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!?"]] = True
_CONT = np.zeros(256, dtype=bool)
_CONT[0x80:0xC0] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
SCORES = ["symbols", "dup_lines", "repeats", "upper", "marks"]


def _count(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    n = len(offs) - 1
    starts, ends, row = tb.words(data, offs)
    prefix = tb.hash_prefix(data)
    h = tb.span_hash(prefix, starts, ends)
    run = lambda mask: (lambda c: c[offs[1:]] - c[offs[:-1]])(np.r_[0, np.cumsum(mask)])
    n_words = np.bincount(row, minlength=n)
    in_word = ~tb._WS[data]
    word_chars = run(in_word & ~_CONT[data])
    # windows that occur again in the same text mark their words
    wh, first = tb.windows(h, row, WINDOW)
    repeated = np.zeros(n, dtype=np.int64)
    if len(wh):
        order = np.lexsort((wh, row[first]))
        a, r = wh[order], row[first][order]
        same = (a[1:] == a[:-1]) & (r[1:] == r[:-1])
        twice = np.r_[same, False] | np.r_[False, same]
        hit = first[order[twice]]
        cover = np.zeros(len(h) + 1, dtype=np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        repeated = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)
    # lines: ends at each \n and at each text's end
    nl = np.flatnonzero(data == 10)
    l_end = np.sort(np.r_[nl, offs[1:]])
    l_row = np.r_[np.searchsorted(offs, nl, side="right") - 1, np.arange(n)]
    l_row = l_row[np.argsort(np.r_[nl, offs[1:]], kind="stable")]
    l_start = np.r_[0, l_end[:-1] + 1] if len(l_end) else l_end
    new_row = np.r_[True, l_row[1:] != l_row[:-1]] if len(l_row) else np.zeros(0, dtype=bool)
    l_start = np.where(new_row, offs[l_row], l_start)
    words_before = np.r_[0, np.cumsum(np.bincount(starts, minlength=len(data) + 1)[: len(data)])] if len(data) else np.zeros(1, dtype=np.int64)
    has_word = words_before[l_end] > words_before[np.minimum(l_start, l_end)]
    l_start, l_end, l_row = l_start[has_word], l_end[has_word], l_row[has_word]
    lh = tb.span_hash(prefix, l_start, l_end)
    order = np.lexsort((lh, l_row))
    lh, lr = lh[order], l_row[order]
    again = (lh[1:] == lh[:-1]) & (lr[1:] == lr[:-1])
    n_dup = np.bincount(lr[1:][again], minlength=n)
    n_lines = np.bincount(l_row, minlength=n)
    return [n_words, word_chars, run(_SYMBOL[data]), n_dup, repeated, n_lines, run(_UPPER[data]), run(_MARK[data])]


def counts_udf():
    """Arrow scalar function: text -> struct of COUNTS."""

    @F.arrow_udf(f"struct<{', '.join(f'{c}: bigint' for c in COUNTS)}>")
    def counts(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            parts = [_count(data, offs) for _, _, data, offs in tb.blocks(texts)]
            cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(len(COUNTS))]
            yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=COUNTS)

    return counts


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs + ``_q8_m`` (struct of COUNTS)."""
    return docs.withColumn("_q8_m", counts_udf()(F.col(text_col)))


def base_failed(m: str = "_q8_m") -> Column:
    return (F.col(f"{m}.n_words") < 10) | (100 * F.col(f"{m}.n_repeat_words") > 20 * F.col(f"{m}.n_words"))


def score_columns(m: str = "_q8_m") -> list[Column]:
    """Badness ratios in thousandths, whole numbers, in the order of SCORES."""
    c = lambda x: F.col(f"{m}.{x}")
    ratio = lambda a, b: F.floor(1000 * a / F.greatest(b, F.lit(1))).cast("bigint")
    return [
        ratio(c("n_symbols"), c("n_words")),
        ratio(c("n_dup_lines"), c("n_lines")),
        ratio(c("n_repeat_words"), c("n_words")),
        ratio(c("n_upper"), c("word_chars")),
        ratio(c("n_marks"), c("n_words")),
    ]


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= x), exact sum in logarithms."""
    if x >= n:
        return 1.0
    lp, lq = math.log(p), math.log1p(-p)
    return min(1.0, math.fsum(
        math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * lp + (n - j) * lq)
        for j in range(x + 1)
    ))


def pick_cutoffs(hist: list[tuple], alpha: float = ALPHA, delta: float = DELTA) -> list[tuple[str, str, int]]:
    """hist rows (stratum, score, grid index or len(GRID), good, bad) -> (stratum, score, cutoff).

    The grid index of a document is the first cutoff that rejects it (len(GRID): none does).
    """
    table: dict = {}
    for stratum, score, g, good, bad in hist:
        t = table.setdefault((stratum, score), np.zeros((2, len(GRID) + 1), dtype=np.int64))
        t[0, g] += good
        t[1, g] += bad
    out = []
    level = delta / max(1, len(table))
    n_scores = Counter(stratum for stratum, _ in table)
    for (stratum, score), t in sorted(table.items()):
        n_good, n_bad = int(t[0].sum()), int(t[1].sum())
        good, bad = np.cumsum(t[0]), np.cumsum(t[1])  # rejected at each cutoff
        best, gain = None, 0.0
        for g, cutoff in enumerate(GRID):
            if n_good == 0 or binomial_cdf(int(good[g]), n_good, alpha / n_scores[stratum]) > level:
                break
            value = bad[g] / max(1, n_bad) - GOOD_COST * good[g] / n_good
            if value > gain + 1e-12:
                best, gain = cutoff, value
        if best is not None:
            out.append((stratum, score, best))
    return out


def fit_cutoffs(measured: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
                alpha: float = ALPHA, delta: float = DELTA) -> list[tuple[str, str, int]]:
    """Cutoffs from the labelled documents that pass the base rules.

    ``measured`` may hold just the id, the stratum and ``_q8_m``. The histogram has at most
    strata x scores x (grid + 1) rows.
    """
    lab = labels.select(F.col(id_col).alias("_q8_id"), F.col("quality").alias("_q8_y")).where("_q8_y in (0, 1)")
    m = measured.select(F.col(id_col).alias("_q8_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("_q8_s"), "_q8_m")
    j = m.where(~base_failed()).join(lab, "_q8_id")
    # first cutoff that the score exceeds: the grid descends
    index = lambda s: F.size(F.filter(F.array(*map(F.lit, GRID)), lambda g: g >= s))
    rows = F.array(*[F.struct(F.lit(n).alias("score"), index(s).alias("g")) for n, s in zip(SCORES, score_columns())])
    hist = (
        j.select("_q8_s", "_q8_y", F.explode(rows).alias("r"))
        .groupBy("_q8_s", "r.score", "r.g")
        .agg(F.sum("_q8_y").alias("good"), F.sum(1 - F.col("_q8_y")).alias("bad"))
    )
    return pick_cutoffs([tuple(r) for r in hist.collect()], alpha, delta)


def verdict(cutoffs: list[tuple[str, str, int]], stratum_col: str = "lang") -> Column:
    """kept: passes the base rules and exceeds no cutoff of its stratum."""
    bad = F.lit(False)
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))
    for name, s in zip(SCORES, score_columns()):
        mine = [(st, c) for st, sc, c in cutoffs if sc == name]
        if mine:
            table = F.create_map(*[F.lit(x) for st, c in mine for x in (st, c)])
            bad = bad | F.coalesce(s > F.try_element_at(table, stratum), F.lit(False))
    return ~base_failed() & ~bad


def quality_verdicts(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, and its scores."""
    m = cut(measure(docs.select("doc_id", "lang", "text")).drop("text"))
    cutoffs = fit_cutoffs(m, labels, alpha=alpha, delta=delta)
    return m.select(
        "doc_id",
        *[F.col(f"_q8_m.{c}").alias(c) for c in COUNTS[:5]],
        base_failed().alias("base_failed"),
        verdict(cutoffs).alias("kept"),
        *[s.alias(f"score_{n}") for n, s in zip(SCORES, score_columns())],
    )


def filter_quality(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The documents kept, with the columns they came with. The texts are measured twice (for the
    cutoffs and for the verdict): cheaper than moving them through a join."""
    cutoffs = fit_cutoffs(cut(measure(docs.select("doc_id", "lang", "text")).drop("text")), labels, alpha=alpha, delta=delta)
    return measure(docs).where(verdict(cutoffs)).drop("_q8_m")
