"""Operator properties: rank under heavy ties, panes == explode, skew-safe IAT == plain IAT."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowlens.operators.packet_features import add_iat, packet_features
from flowlens.operators.rank import packet_rank, running_sums
from flowlens.operators.windows import window_features
from flowlens.plans.queries_prep import clean


def test_rank_with_a_heavy_tied_value(spark):
    # a third of the rows share one time value: it must still spread over several buckets
    rows = [(i, 5.0 if i % 3 == 0 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "no bigint, time double")
    got = packet_rank(df, num_buckets=16).select("no", "rank")
    exp = df.select("no", (F.row_number().over(Window.orderBy("time", "no")) - 1).alias("rank"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_keyed_running_sums(spark):
    rows = [(i % 4, float(random.Random(i).randint(0, 50)), i, 1 + i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t double, no bigint, v bigint")
    got = running_sums(df, {"cs": F.col("v")}, ("t", "no"), keys=["k"], num_buckets=8).select("k", "no", "cs")
    w = Window.partitionBy("k").orderBy("t", "no").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "no", F.sum("v").over(w).alias("cs"))
    assert got.exceptAll(exp).count() == 0


@pytest.mark.parametrize("size,step", [(100, 10), (64, 24), (50, 7), (20, 20)])
def test_panes_equal_explode(spark, size, step):
    f = packet_features(clean(spark, SF_SMALL)).cache()
    a = window_features(f, size, step, method="explode").toPandas().sort_values("window_idx").reset_index(drop=True)
    b = window_features(f, size, step, method="panes").toPandas().sort_values("window_idx").reset_index(drop=True)
    assert len(a) == len(b) > 0
    pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9, atol=1e-9)


def test_fewer_packets_than_window_gives_no_window(spark):
    f = packet_features(clean(spark, SF_SMALL)).limit(50)
    assert window_features(f, 100, 10).count() == 0


def test_skew_safe_iat_equals_plain(spark):
    p = packet_features(clean(spark, SF_SMALL), skew_safe=False).select("no", "iat")
    q = packet_features(clean(spark, SF_SMALL), skew_safe=True, num_buckets=32).select("no", "iat")
    assert p.exceptAll(q).count() == 0


def test_hot_flow_iat(spark):
    # one flow holds most rows: the bucket-stitched lag must equal the plain lag
    rows = [(i, float(i) * 0.5, "hot" if i % 10 else f"f{i % 7}") for i in range(4000)]
    df = spark.createDataFrame(rows, "no bigint, time double, flow_id string")
    a = add_iat(df, skew_safe=False).select("no", "iat")
    b = add_iat(df, skew_safe=True, num_buckets=16).select("no", "iat")
    assert a.exceptAll(b).count() == 0


def test_bucket_count_does_not_change_ranks(spark):
    df = clean(spark, SF_SMALL).select("no", "time")
    spark.conf.set("flowlens.rank.buckets", "3")
    try:
        a = packet_rank(df).select("no", "rank")
    finally:
        spark.conf.unset("flowlens.rank.buckets")
    b = packet_rank(df, num_buckets=64).select("no", "rank")
    assert a.exceptAll(b).count() == 0


def test_bootstrap_shares(spark):
    from flowlens.operators.sample import bootstrap_class_dist

    rows = [(i, i % 4 if i % 10 else 4) for i in range(1000)]
    w = spark.createDataFrame(rows, "window_idx bigint, Label int")
    b = bootstrap_class_dist(w).toPandas()
    assert b["rep"].nunique() == 200
    assert (b.groupby("rep")["share"].sum().round(9) == 1.0).all()
    mean = b.groupby("Label")["share"].mean()
    labels = [r[1] for r in rows]
    for lab in set(labels):
        assert abs(mean[lab] - labels.count(lab) / len(labels)) < 0.01


def test_nan_time_is_dropped(spark):
    from flowlens.operators.clean import clean_packets

    rows = [("1.5", "a", "60", None), ("NaN", "a", "60", None), (None, "a", "60", None)]
    df = spark.createDataFrame(rows, "time string, destination string, length string, info string")
    assert [r.time for r in clean_packets(df).collect()] == [1.5]
