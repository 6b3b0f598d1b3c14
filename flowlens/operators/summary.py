"""Dashboard overview aggregates (E13-E17) on the window table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import (
    CLASS_NAMES,
    SUMMARY_CLIP_PCT,
    SUMMARY_HIST_BINS,
    SUMMARY_HIST_FEATURES,
    SUMMARY_SAMPLE,
    SUMMARY_STAT_FEATURES,
)
from flowlens.functions.packet import class_name, exact_avg, py_round
from flowlens.operators.eda import exact_percentiles, histogram
from flowlens.operators.sample import sample_series


def class_dim(spark) -> DataFrame:
    """The five classes (fixed size: broadcast)."""
    return spark.createDataFrame(sorted(CLASS_NAMES.items()), "class_id int, class_name string")


def summary_kpi(windows: DataFrame, label: str = "Label") -> DataFrame:
    """Windows, packets, attack windows, attack %, distinct classes (one aggregate)."""
    return windows.agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.sum("pkt_count").cast("bigint").alias("total_packets"),
        F.sum(F.when(F.col(label) != 0, 1).otherwise(0)).cast("bigint").alias("attack_windows"),
        F.count_distinct(label).alias("n_classes"),
    ).withColumn("attack_pct", py_round(F.col("attack_windows") * 100.0 / F.greatest(F.col("total_windows"), F.lit(1)), 1))


def summary_class_dist(windows: DataFrame, label: str = "Label") -> DataFrame:
    """Count and % per class; every class listed, absent ones with 0."""
    counts = windows.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = windows.agg(F.count(F.lit(1)).alias("_t"))
    dim = F.broadcast(class_dim(windows.sparkSession))
    j = dim.join(counts, dim["class_id"] == counts[label], "left").crossJoin(F.broadcast(total))
    c = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    return j.select("class_id", "class_name", c.alias("count"),
                    py_round(c * 100.0 / F.greatest(F.col("_t"), F.lit(1)), 1).alias("pct"))


def summary_stats(windows: DataFrame, label: str = "Label", feats=SUMMARY_STAT_FEATURES) -> DataFrame:
    """Per present class, the mean of the key features (4 decimals)."""
    present = windows.where(F.col(label).isin(list(CLASS_NAMES)))
    return present.groupBy(label).agg(
        F.count(F.lit(1)).alias("count"), *[py_round(exact_avg(f), 4).alias(f) for f in feats]
    ).withColumn("class_name", class_name(label))


def summary_hists(windows: DataFrame, label: str = "Label", feats=SUMMARY_HIST_FEATURES,
                  bins: int = SUMMARY_HIST_BINS, pct: float = SUMMARY_CLIP_PCT) -> DataFrame:
    """30-bin count histograms per (feature, class), values clipped above at the
    global 98th percentile of the feature (the maximum when there are <= 10 windows)."""
    cls = windows.where(F.col(label).isin(list(CLASS_NAMES)))
    melt = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in feats]))
    allv = windows.select("window_idx", melt.alias("m")).select("window_idx", "m.feature", "m.v")
    # all clip points in one keyed percentile pass (feature is the key)
    q = exact_percentiles(allv, "v", [pct], ["feature"], tiebreak="window_idx").select("feature", F.col("value").alias("_q"))
    mx = allv.groupBy("feature").agg(F.max("v").alias("_mx"), F.count(F.lit(1)).alias("_cnt"))
    cap = q.join(mx, "feature").select("feature", F.when(F.col("_cnt") > 10, F.col("_q")).otherwise(F.col("_mx")).alias("_cap"))
    x = cls.select(label, melt.alias("m")).select(label, "m.feature", "m.v")
    # one row per feature: fixed size, broadcast
    clipped = x.join(F.broadcast(cap), "feature").select("feature", label, F.least(F.col("v"), F.col("_cap")).alias("v"))
    return histogram(clipped, "v", bins, ["feature", label]).withColumn("class_name", class_name(label))


def summary_series(windows: DataFrame, label: str = "Label", n: int = SUMMARY_SAMPLE, order: Column | None = None) -> DataFrame:
    """<= 500 sampled windows (D3) with rounded values and class name."""
    s = sample_series(windows.select("window_idx", "time_start", "pkt_rate", "syn_ratio", label).dropna(), n, order=order)
    return s.orderBy("time_start", "window_idx").select(
        "window_idx",
        py_round("time_start", 3).alias("t"),
        py_round("pkt_rate", 2).alias("pkt_rate"),
        py_round("syn_ratio", 4).alias("syn_ratio"),
        class_name(label).alias("label"),
    )
