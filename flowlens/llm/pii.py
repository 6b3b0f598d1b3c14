"""Operator 5: personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base patterns (e-mail, IPv4, card number with Luhn test, international phone number) give the seed
entities. Every token with a digit or @ is a candidate instance; its lexical patterns are the one
and the two words to its left, each with the token's shape (letters a, digits 0). Patterns
and token values form a bipartite graph whose edges count occurrences. Starting from values
that are seeds (confidence 1), a pattern's confidence in a kind is the confidence-weighted
share of its occurrences (one added to the denominator), and a value's confidence is the weighted mean of
its patterns; after ``ROUNDS`` rounds patterns of at least ``MIN_CONF`` confidence and
``MIN_SEEDS`` distinct seed values add each further token that they cover and that no base span overlaps.

Positions count code points, ends are exclusive. The regular expressions are written with possessive
quantifiers and fixed starts that accept the same matches as the plain forms, so that a long run of
characters costs time in proportion, and no stack.

Defined results: a null text is empty (no spans); repeated rows get the same spans each; an
empty table gives an empty result; other columns pass through ``redact`` untouched
(helper columns start with ``_p5_``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import cut

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
MIN_CONF = 0.8
MIN_SEEDS = 8
#: most rows with added spans that are broadcast to the texts
BROADCAST_ROWS = 20_000

#: a match may start where a run of its characters starts or the match before ended
REGEX = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GATE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_STEP = 256


def _starts(pieces: Column, hits: Column) -> Column:
    """Start of each hit: lengths of all before it, summed in two levels (long lists stay cheap)."""
    zero = F.lit(0)
    add = lambda a, x: a + x
    each = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(pieces, i)))
    blocks = F.transform(
        F.sequence(zero, F.floor(F.size(hits) / _STEP).cast("int")),
        lambda b: F.aggregate(F.slice(each, b * _STEP + 1, F.lit(_STEP)), zero, add))

    def start(i):
        b = F.floor(i / _STEP).cast("int")
        before = F.aggregate(F.slice(blocks, F.lit(1), b), zero, add)
        inside = F.aggregate(F.slice(each, b * _STEP + 1, i - b * _STEP), zero, add)
        return before + inside + F.length(F.get(pieces, i))

    return F.transform(hits, lambda h, i: start(i))


def _digits(h: Column) -> Column:
    return F.regexp_replace(h, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(a, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, h: Column) -> Column:
    if kind == "ip":
        small = lambda p: F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("bigint"), F.lit(0))
        plain = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        return F.forall(F.split(h, r"\."), lambda p: plain(p) & (small(p) <= 255))
    if kind == "card":
        n = F.length(_digits(h))
        return F.when((n >= 14) & (n <= 19), _luhn(_digits(h))).otherwise(F.lit(False))
    if kind == "phone":
        n = F.length(_digits(h))
        return (n >= 10) & (n <= 15)
    return F.lit(True)


def _kind_spans(kind: str, hits: Column, pieces: Column) -> Column:
    pairs = F.arrays_zip(_starts(pieces, hits).alias("s"), hits.alias("h"))
    good = F.filter(pairs, lambda p: _valid(kind, p["h"]))
    return F.transform(good, lambda p: F.struct(
        p["s"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (p["s"] + F.length(p["h"])).alias("end")))


def _with_base(df: DataFrame) -> DataFrame:
    """Adds ``_p5_base``: array of (start, kind number, end), sorted."""
    t = F.col("_p5_t")
    for kind in KINDS:
        empty = F.array().cast("array<string>")
        df = df.withColumn(f"_p5_h_{kind}", F.when(GATE[kind](t), F.regexp_extract_all(t, F.lit(REGEX[kind]), F.lit(0))).otherwise(empty))
        df = df.withColumn(f"_p5_s_{kind}", F.when(F.size(f"_p5_h_{kind}") > 0, F.split(t, REGEX[kind], -1)).otherwise(empty))
    spans = []
    for kind in KINDS:
        spans.append(_kind_spans(kind, F.col(f"_p5_h_{kind}"), F.col(f"_p5_s_{kind}")))
    any_hit = sum(F.size(f"_p5_h_{k}") for k in KINDS) > 0
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    df = df.withColumn("_p5_base", F.when(any_hit, F.array_sort(F.concat(*spans))).otherwise(none))
    return df.drop(*[f"_p5_{x}_{k}" for x in "hs" for k in KINDS])


def _with_tokens(df: DataFrame) -> DataFrame:
    """Adds ``_p5_tok``: array of (start, end, value, shape, words to the left, seed kind or null)."""
    t = F.col("_p5_t")
    empty = F.array().cast("array<string>")
    df = df.withColumn("_p5_h", F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0))).otherwise(empty))
    df = df.withColumn("_p5_s", F.when(F.size("_p5_h") > 0, F.split(t, TOKEN, -1)).otherwise(empty))
    left = F.transform("_p5_s", lambda p: F.lower(F.trim(F.right(F.translate(p, "\t\n\x0b\f\r", "     "), F.lit(64)))))
    zipped = F.arrays_zip(_starts(F.col("_p5_s"), F.col("_p5_h")).alias("s"), F.col("_p5_h").alias("h"),
                          F.slice(left, F.lit(1), F.size("_p5_h")).alias("l"))

    def token(p):
        lead = F.length(F.regexp_extract(p["h"], r"^[(\[{<\"']*+", 0))
        value = F.regexp_replace(F.regexp_replace(p["h"], r"^[(\[{<\"']++", ""), r"(?<![)\]}>\"',.;:!?])[)\]}>\"',.;:!?]++$", "")
        return F.struct((p["s"] + lead).alias("start"), (p["s"] + lead + F.length(value)).alias("end"),
                        F.lower(value).alias("value"), p["l"].alias("left"))

    df = df.withColumn("_p5_tok", F.transform(zipped, token)).drop("_p5_h", "_p5_s")
    base = F.col("_p5_base")
    # a token is the seed of the base span that starts in it; a token that a span only reaches is dropped
    own = lambda x: F.filter(base, lambda b: (b["start"] >= x["start"]) & (b["start"] < x["end"]))
    free = lambda x: ~F.exists(base, lambda b: (b["start"] < x["start"]) & (b["end"] > x["start"]))
    tokens = F.transform(F.filter("_p5_tok", lambda x: free(x) & (x["end"] > x["start"])), lambda x: F.struct(
        x["start"], x["end"], x["value"], x["left"], F.get(own(x), F.lit(0))["kind"].alias("kind")))
    return df.withColumn("_p5_tok", tokens)


def _shape(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]", "0")


def induce(instances: DataFrame, rounds: int = ROUNDS, min_conf: float = MIN_CONF, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """Graph scoring. instances: (key, start, end, value, pats array, kind or null) ->
    (key, start, end, kind) of the tokens that trusted patterns add."""
    edges = cut(instances.select("value", "kind", F.explode("pats").alias("pat")).groupBy("pat", "value", "kind").agg(F.count(F.lit(1)).alias("n")))
    total = edges.groupBy("pat").agg(F.sum("n").alias("total"))
    seeds = cut(edges.where("kind is not null").groupBy("value").agg(F.min("kind").alias("k")).withColumn("conf", F.lit(1.0)))
    known, total = seeds, cut(total)
    pattern = None
    for r in range(rounds):
        hit = edges.join(known, "value").groupBy("pat", "k").agg(F.sum(F.col("n") * F.col("conf")).alias("w"))
        pattern = cut(hit.join(total, "pat").select("pat", "k", (F.col("w") / (F.col("total") + 1)).alias("score")))
        if r + 1 < rounds:
            open_edges = edges.where("kind is null")
            mass = cut(open_edges.groupBy("value").agg(F.sum("n").alias("all")))
            value = open_edges.join(pattern, "pat").groupBy("value", "k").agg(F.sum(F.col("n") * F.col("score")).alias("w"))
            found = value.join(mass, "value").select("value", "k", (F.col("w") / F.col("all")).alias("conf"))
            known = cut(seeds.select("value", "k", "conf").unionByName(found))
    support = edges.where("kind is not null").groupBy("pat", F.col("kind").alias("k")).agg(F.count(F.lit(1)).alias("seeds"))
    trusted = cut(pattern.where(F.col("score") >= min_conf).join(support.where(F.col("seeds") >= min_seeds), ["pat", "k"]).select("pat", "k", "score"))
    rest = instances.where("kind is null").select("key", "start", "end", F.explode("pats").alias("pat"))
    best = rest.join(trusted, "pat").groupBy("key", "start", "end").agg(F.max(F.struct("score", -F.col("k"))).alias("b"))
    return best.select("key", "start", "end", (-F.col("b.col2")).alias("kind"))


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    d = docs.withColumn("_p5_t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return _with_tokens(_with_base(d))


def _key(id_col: str) -> Column:
    """Rows that repeat id and text share a key, and so their spans."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.xxhash64("_p5_t").cast("string"))


def _added(rows: DataFrame) -> DataFrame:
    """key -> array of added spans, from rows with key and tokens."""
    # rows that repeat a key are one instance
    i = rows.where(F.size("_p5_tok") > 0).select("key", F.explode("_p5_tok").alias("x")).distinct()
    words = F.split(F.col("x.left"), " +")
    one = F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit(""))
    two = F.concat_ws(" ", F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit("")), one)
    shape = _shape(F.col("x.value"))
    pats = F.array_distinct(F.array(F.concat_ws("|", F.lit("1"), one, shape), F.concat_ws("|", F.lit("2"), two, shape)))
    inst = cut(i.select("key", "x.start", "x.end", "x.value", "x.kind", pats.alias("pats")))
    return cut(induce(inst).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("more")))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``spans`` (arrays of (start, kind number, end))."""
    rows = _prepared(docs.select(F.col(id_col), F.col(text_col).alias("_p5_text")), "_p5_text")
    rows = cut(rows.select(id_col, _key(id_col).alias("key"), F.col("_p5_base").alias("base"), "_p5_tok"))
    more = _added(rows)
    joined = rows.drop("_p5_tok").join(more, "key", "left")
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    return joined.select(id_col, "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("bigint")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in angle brackets; spans that overlap become the
    first one's mark. A null text stays null. Only rows with added spans are needed beside the
    texts, broadcast when they are few."""
    names = docs.columns
    rows = _prepared(docs.select(F.col(id_col), F.col(text_col).alias("_p5_text")), "_p5_text")
    # written before it is filtered: a filter pushed below would evaluate the patterns again and again
    more = _added(cut(rows.select(_key(id_col).alias("key"), "_p5_tok")))
    if more.count() <= BROADCAST_ROWS:
        more = F.broadcast(more)
    d = _with_base(docs.withColumn("_p5_t", F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    d = d.withColumn("_p5_key", _key(id_col)).join(more.withColumnsRenamed({"key": "_p5_key", "more": "_p5_more"}), "_p5_key", "left")
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    d = d.withColumn("_p5_all", F.array_sort(F.concat("_p5_base", F.coalesce("_p5_more", none))))
    # spans merged where they overlap: one mark for each stretch
    kinds = F.array(*map(F.lit, KINDS))
    stretch = "array<struct<start: int, kind: int, end: int>>"

    def merge(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (s["start"] < last["end"]),
                      F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    d = d.withColumn("_p5_m", F.aggregate("_p5_all", F.array().cast(stretch), merge))
    t, m = F.col("_p5_t"), F.col("_p5_m")

    def piece(s, i):
        begin = F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(F.lit(0))
        return F.concat(F.substring(t, begin + 1, s["start"] - begin), F.lit("<"), F.get(kinds, s["kind"]), F.lit(">"))

    tail = F.substring(t, F.try_element_at(m, F.lit(-1))["end"] + 1, F.length(t))
    text = F.when(F.size(m) > 0, F.concat(F.array_join(F.transform(m, piece), ""), tail)).otherwise(F.col(text_col))
    return d.withColumn("_p5_new", text).select(*[F.col("_p5_new").alias(c) if c == text_col else F.col(f"`{c}`") for c in names])
