"""The default window plan (chunks of sorted positions) gives the rows of the per-window aggregate."""

import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators import windows
from flowlens.operators.windows import window_features

SCHEMA = ("time double, no bigint, length int, iat double, source string, destination string, flow_id string, dst_port int, "
          "src_port int, proto_num smallint, label int, "
          + ", ".join(f"flag_{f} tinyint" for f in windows.FLAG_COLS))


def _packets(spark, n):
    rnd = random.Random(3)
    some = lambda v: None if rnd.random() < 0.05 else v
    rows = [(round(rnd.uniform(0, 50), 1), i, some(rnd.randrange(40, 1500)), some(round(rnd.uniform(0, 0.3), 4)),
             some(f"10.0.0.{rnd.randrange(9)}"), f"10.0.1.{rnd.randrange(9)}", f"f{rnd.randrange(20)}", some(rnd.randrange(80, 90)),
             rnd.randrange(5), some(rnd.choice([6, 17, 53])), rnd.randrange(4), *[some(rnd.randrange(2)) for _ in windows.FLAG_COLS])
            for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n,size,step,dashboard", [(700, 40, 10, False), (700, 40, 10, True), (333, 7, 3, False), (160, 5, 8, False),
                                                   (39, 40, 10, False), (40, 40, 10, False)])
def test_chunks_equal_explode(spark, monkeypatch, n, size, step, dashboard):
    monkeypatch.setattr(windows, "CHUNK_ROWS", 50)  # several chunks from few rows
    monkeypatch.setattr(windows, "CHUNK_SIZES", 1)
    p = _packets(spark, n)
    a, b = (window_features(p, size, step, method=m, dashboard=dashboard).orderBy("window_idx").collect() for m in ("explode", "chunks"))
    assert len(a) == len(b) == max(0, (n - size) // step + 1)
    for x, y in zip(a, b):
        for c in x.asDict():
            assert x[c] == (pytest.approx(y[c], rel=1e-12, abs=1e-12) if isinstance(x[c], float) else y[c]), c


def test_default_plan_holds_no_lists_per_window(spark):
    """The lists of every window used to be updated packet by packet in an object hash aggregate keyed by the window, which
    falls back to sorting after 128 windows."""
    plan = window_features(_packets(spark, 50), 40, 10)._jdf.queryExecution().executedPlan().toString()
    listed = [x for x in plan.splitlines() if "collect_" in x and "Aggregate" in x]
    assert listed and all("keys=[_chunk#" in x for x in listed)


def test_keyed_windows_from_a_first_one(spark):
    p = _packets(spark, 500).withColumn("key", F.concat(F.lit("k"), (F.col("no") % 2).cast("string")))
    placed = p.withColumn("rank", F.floor(F.col("no") / 2).cast("bigint")).withColumn("_n", F.lit(250).cast("bigint")).withColumn("_first", F.lit(3))
    got = windows.windows_at_positions(placed.where("rank >= 30"), 40, 10, True, ["key"]).collect()
    assert sorted((r.key, r.window_idx) for r in got) == [(k, 10 * w) for k in ("k0", "k1") for w in range(3, 22)]
    assert {r.pkt_count for r in got} == {40}
