"""Operator 12: interaction audit of document filters, by a table-driven byte transducer.

One pass of a two-state transducer over the UTF-8 bytes of each text counts words, capital letters, code
points and symbols: the table ``OUT`` holds, for each (state, byte), what the step emits. The spans of the
words it leaves are inserted into an open-addressing hash table whose matches are verified byte by byte,
so the number of distinct words is exact. Each text fails some of the filters A to E:

A  under 200 words                      B  100 * distinct words < 50 * words
C  100 * capitals > 3 * code points     D  holds a symbol of ``#$%&*|``
E  the same text has a smaller doc_id somewhere in the table

Texts meet in Spark by their SHA-256, as narrow rows of counts, so copies of one text are summed before
they are shuffled and never gathered. What remains is a count per (part, failed filters, labels), at most
128 rows a part; every order of the filters is read off that table.

Defined results: a null text is an empty one, a null part an empty string; a text without words fails A only
(of A to D). Repeated rows count each; rows with the smallest doc_id of a text do not fail E, nor do rows whose
doc_id is null, which are not anybody's smaller doc_id either. A document is good (toxic) when any of its label rows
says quality = 1 (toxic = 1). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
MEASURES = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

#: bits that a step of the transducer emits
BEGIN, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(state after each byte, emitted bits by 256 * state + byte); state 1 is inside a word."""
    after = np.ones(256, dtype=np.uint8)
    after[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    byte = np.arange(256)
    always = np.where((byte < 0x80) | (byte >= 0xC0), POINT, 0)
    always |= np.where((byte >= 65) & (byte <= 90), CAPITAL, 0)
    always |= np.where(np.isin(byte, np.frombuffer(SYMBOLS, dtype=np.uint8)), SYMBOL, 0)
    return after, np.r_[always | np.where(after == 1, BEGIN, 0), always].astype(np.uint8)


AFTER, OUT = _tables()


def transduce(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(emitted bits of each byte, starts of words, ends of words) of a block of texts."""
    state = AFTER[data]
    before = np.zeros(len(data), dtype=np.uint16)
    before[1:] = state[:-1]
    edge = offs[offs < len(data)]
    before[edge] = 0
    out = OUT[(before << 8) | data]
    starts = np.flatnonzero(out & BEGIN)
    stop = np.ones(len(data), dtype=bool)
    stop[:-1] = state[1:] == 0
    stop[edge[edge > 0] - 1] = True
    return out, starts, np.flatnonzero(stop & (state == 1)) + 1


def _equal_spans(eight: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes of equally long spans are equal, eight at a time."""
    same = np.ones(len(a), dtype=bool)
    left = np.arange(len(a))
    at = 0
    while len(left):
        n = np.minimum(size[left] - at, 8)
        diff = (eight[a[left] + at] ^ eight[b[left] + at]) << ((8 - n) * 8).astype(np.uint64)
        same[left[diff != 0]] = False
        at += 8
        left = left[(diff == 0) & (size[left] > at)]
    return same


def first_occurrences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Marks the spans that are the first of their bytes in their row.

    All spans go through the table together: those whose slot is free claim it (the earliest span wins), the
    others are compared with the owner of the slot by row, length and bytes, and step on when they differ. The hash
    only chooses slots and spares comparisons.
    """
    first = np.zeros(len(starts), dtype=bool)
    size = ends - starts
    bits = max(3, int(2 * len(starts)).bit_length())
    mask = np.int64((1 << bits) - 1)
    owner = np.full(1 << bits, -1, dtype=np.int64)
    padded = np.r_[data, np.zeros(8, dtype=np.uint8)]
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    with np.errstate(over="ignore"):
        key = tb.splitmix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    pending = np.arange(len(starts))
    while len(pending):
        at = slot[pending]
        free = owner[at] < 0
        owner[at[free][::-1]] = pending[free][::-1]
        held = owner[at]
        first[pending[held == pending]] = True
        pending, held = pending[held != pending], held[held != pending]
        like = (row[pending] == row[held]) & (size[pending] == size[held]) & (key[pending] == key[held])
        like[like] = _equal_spans(eight, starts[pending[like]], starts[held[like]], size[pending[like]])
        pending = pending[~like]
        slot[pending] = (slot[pending] + 1) & mask
    return first


def _measure(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    n = len(offs) - 1
    out, starts, ends = transduce(data, offs)
    row = np.searchsorted(offs, starts, side="right") - 1
    first = first_occurrences(data, starts, ends, row, tb.span_hash(tb.hash_prefix(data), starts, ends))

    def per_row(bit: int) -> np.ndarray:
        total = np.r_[0, np.cumsum((out & bit) != 0)]
        return total[offs[1:]] - total[offs[:-1]]

    return [np.bincount(row, minlength=n), np.bincount(row[first], minlength=n), per_row(CAPITAL), per_row(POINT), per_row(SYMBOL)]


def measures_udf():
    """Arrow scalar function: text -> struct of MEASURES."""

    @F.arrow_udf(f"struct<{', '.join(f'{c}: bigint' for c in MEASURES)}>")
    def measures(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            parts = [_measure(data, offs) for _, _, data, offs in tb.blocks(texts)]
            cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(len(MEASURES))]
            yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=MEASURES)

    return measures


def failed_filters(m: str) -> Column:
    """The letters of A to D that a measured text fails, in order."""
    c = lambda x: F.col(f"{m}.{x}")
    letter = lambda cond, name: F.when(cond, F.lit(name)).otherwise(F.lit(""))
    return F.concat(
        letter(c("n_words") < 200, "A"),
        letter(100 * c("n_distinct") < 50 * c("n_words"), "B"),
        letter(100 * c("n_capitals") > 3 * c("n_points"), "C"),
        letter(c("n_symbols") > 0, "D"),
    )


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, fails, good, toxic, n): documents by the letters of all filters they fail and by their labels."""
    m = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    m = m.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), measures_udf()("text").alias("m"))
    m = m.select("doc_id", "part", "digest", failed_filters("m").alias("fails"))
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    marks = labels.groupBy("doc_id").agg(says("quality"), says("toxic"))
    marked = m.join(marks, "doc_id", "left").fillna(False, ["quality", "toxic"])
    alike = ["digest", "part", "fails", "quality", "toxic"]
    per_id = marked.groupBy(*alike, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    group = per_id.groupBy(*alike).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("lowest"), F.min_by("n", "doc_id").alias("at_lowest"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    # a group per text, part and labels: a few rows a text, however many copies it has
    lowest = F.min("lowest").over(Window.partitionBy("digest"))
    kept = F.col("unnamed") + F.when(F.col("lowest") == lowest, F.col("at_lowest")).otherwise(0)
    split = group.select("part", "fails", "quality", "toxic", "n", kept.alias("kept")).select(
        "part", F.col("quality").alias("good"), "toxic",
        F.explode(F.array(F.struct(F.col("fails").alias("fails"), F.col("kept").alias("n")),
                          F.struct(F.concat("fails", F.lit("E")).alias("fails"), (F.col("n") - F.col("kept")).alias("n")))).alias("s"))
    return split.groupBy("part", F.col("s.fails").alias("fails"), "good", "toxic").agg(F.sum("s.n").alias("n"))


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, zeros included."""
    counts = failure_counts(docs, labels, part)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    n, zero = F.col("n"), F.lit(0)
    fails = F.expr("instr(fails, filter) > 0")
    gone = F.expr("translate(substring(filter_order, 1, step - 1), fails, '') <> substring(filter_order, 1, step - 1)")
    total = lambda cond, name: F.sum(F.when(cond, n).otherwise(zero)).cast("bigint").alias(name)
    table = steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone, "kept"),
        total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("fails") == F.col("filter"), "unique_fails"),
        total(fails & ~gone & F.col("good"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley")  # 120 rows a group
    return table.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant",
                        "unique_fails", "good_lost", "toxic_lost", shapley)
