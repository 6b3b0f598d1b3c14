"""Replay of a scored window sequence (W4-W6, P8, E18, E19) as set operations.

The reference walks the prediction rows one by one; here running totals come from the
two-level running sum, the timeline tail and snapshots are predicates on the running
index, and the final totals are one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, SNAPSHOT_EVERY, TIMELINE_LEN
from flowlens.functions.packet import py_round
from flowlens.operators.rank import running_sums


def threats(pred: DataFrame, name: str = "prediction") -> DataFrame:
    """Windows not predicted Normal."""
    return pred.where(F.col(name) != F.lit("Normal"))


def prediction_counts(pred: DataFrame, name: str = "prediction") -> DataFrame:
    """Windows per predicted class."""
    return pred.groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def running_counters(pred: DataFrame, order_by: tuple[str, str], name: str = "prediction",
                     total_col: str | None = None) -> DataFrame:
    """1-based window index, cumulative threats and cumulative count of each class; ``total_col`` adds the number of
    all windows to every row (what the timeline and the snapshots need), from the offset table of the same plan."""
    sums = {"win_idx": F.lit(1).cast("bigint"),
            "total_threats": F.when(F.col(name) != "Normal", 1).otherwise(0).cast("bigint")}
    for _, cname in sorted(CLASS_NAMES.items()):
        sums[f"n_{cname}"] = F.when(F.col(name) == cname, 1).otherwise(0).cast("bigint")
    return running_sums(pred, sums, order_by, totals={"win_idx": total_col} if total_col else None)


def timeline_tail(counters: DataFrame, conf: str = "confidence", name: str = "prediction", n: int = TIMELINE_LEN,
                  total_col: str = "total_windows") -> DataFrame:
    """The last ``n`` windows: label W<i>, confidence under normal or threat (3 decimals)."""
    c = py_round(conf, 3)
    is_t = F.col(name) != "Normal"
    return counters.where(F.col("win_idx") > F.col(total_col) - n).select(
        "win_idx", F.concat(F.lit("W"), F.col("win_idx").cast("string")).alias("label"),
        F.when(is_t, F.lit(0.0)).otherwise(c).alias("normal"), F.when(is_t, c).otherwise(F.lit(0.0)).alias("threat"))


def metrics_snapshots(counters: DataFrame, every: int = SNAPSHOT_EVERY, total_col: str = "total_windows") -> DataFrame:
    """The counters every ``every`` windows and at the last one, with progress %."""
    cls = [f"n_{c}" for _, c in sorted(CLASS_NAMES.items())]
    return counters.where((F.col("win_idx") % every == 0) | (F.col("win_idx") == F.col(total_col))).select(
        "win_idx", "total_threats", *cls,
        F.least(F.lit(95), F.floor(F.lit(5.0) + (F.col("win_idx") / F.col(total_col)) * F.lit(90.0)).cast("int")).alias("progress"))


def replay_summary(pred: DataFrame, name: str = "prediction", packets: DataFrame | None = None) -> DataFrame:
    """Final totals: windows, threats, packets (the rows of the cleaned capture, when it is given; windows overlap, so
    their packet counts do not add up to it) and the count of every class."""
    out = pred.agg(F.count(F.lit(1)).alias("windows"),
                   F.sum(F.when(F.col(name) != "Normal", 1).otherwise(0)).cast("bigint").alias("total_threats"),
                   *[F.sum(F.when(F.col(name) == c, 1).otherwise(0)).cast("bigint").alias(f"n_{c}")
                     for _, c in sorted(CLASS_NAMES.items())])
    if packets is None:
        return out
    return out.crossJoin(packets.agg(F.count(F.lit(1)).alias("total_packets")))  # one row each
