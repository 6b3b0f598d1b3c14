"""Operator 4 and the pipeline's second stage: what comes to the driver, and what the sketches of long texts let pass."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm import partenum as pe
from flowlens.llm import textbytes as tb


def test_bitmap_is_made_by_spark(spark, monkeypatch):
    bits = 1 << 17
    slots = np.unique(np.r_[0, 1, 7, 8, 32767, 32768, 65535, bits - 1, np.random.default_rng(3).integers(0, bits, 40_000)])
    want = np.zeros(bits, dtype=bool)
    want[slots] = True
    df = spark.createDataFrame([(int(s),) for s in np.r_[slots, slots[:99]]], "slot bigint").repartition(5)
    rows = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: rows.extend(got := collect(self)) or got)
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: (_ for _ in ()).throw(AssertionError("slots on the driver")))
    assert (pe._bitmap(df, bits) == np.packbits(want, bitorder="little")).all()
    assert len(rows) <= bits // 32768  # pieces, not slots
    assert not pe._bitmap(df.where("slot < 0"), bits).any()


def _pair(rng, n: int, m: int, common: int):
    x = tb.splitmix(rng.integers(0, 1 << 62, n + m - common).astype(np.uint64))
    return np.sort(x[:n]), np.sort(x[n - common :])


def _passes(sets, num=80, den=100) -> bool:
    size = [len(s) for s in sets]
    a, b = pe._sketches(np.concatenate(sets), np.r_[0, np.cumsum(size)])
    row = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "a_n": [size[0]], "b_n": [size[1]], "a_sketch": [a], "b_sketch": [b]})
    return sum(x.num_rows for x in pe._may_link(num, den)(iter([row]))) == 1


def test_sketches_keep_links_and_drop_long_strangers():
    rng = np.random.default_rng(5)
    for n in (5, 900, 1024, 1025, 3000, 9000):
        # as unlike as a link may be: of unequal sizes (widths of sketches may differ) and of equal ones
        assert _passes(_pair(rng, n, n * 8 // 10, n * 8 // 10))
        assert _passes(_pair(rng, n, n, -(-n * 8 // 9)))
    for n in (2500, 6000, 12_000):  # 1024 bits are full here and let such pairs pass
        assert not _passes(_pair(rng, n, n, n // 2))
        assert not _passes(_pair(rng, n, n * 9 // 10, n // 2))
