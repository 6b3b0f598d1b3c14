"""per-packet features (protocol number, ports, flags, flow id, per-flow IAT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.constants import TCP_FLAGS
from flowlens.functions import packet as pf
from flowlens.operators.rank import BUCKET, add_order_bucket


def parse_packets(df: DataFrame) -> DataFrame:
    """F1-F4 (narrow, no shuffle). Info and Protocol are dropped afterwards."""
    out = df.select(
        "*",
        pf.proto_num("protocol").alias("proto_num"),
        pf.src_port("info").alias("src_port"),
        pf.dst_port("info").alias("dst_port"),
        *[pf.flag(f, "info").alias(f"flag_{f}") for f in TCP_FLAGS],
    )
    return out.withColumn("flow_id", pf.flow_id()).drop("info", "protocol")


def add_gap(
    df: DataFrame,
    partition: list[str],
    order_by: tuple[str, str],
    out: str,
    float32: bool = False,
    skew_safe: bool = True,
    num_buckets: int | None = None,
) -> DataFrame:
    """``t - previous t`` within ``partition`` in (t, tie-break) order; first row 0.

    ``skew_safe`` partitions the lag by (partition, order bucket) instead of by the
    partition alone, so one flood flow holding most packets (or an empty partition
    list: the global order) is spread over many tasks. The first row of each
    (partition, bucket) takes the last value of the previous non-empty bucket from a
    small (partition, bucket) aggregate.
    """
    t, tb = order_by

    def finish(frame: DataFrame, prev) -> DataFrame:
        gap = F.coalesce(F.col(t) - prev, F.lit(0.0))
        return frame.withColumn(out, gap.cast("float").cast("double") if float32 else gap)

    if not skew_safe:
        return finish(df, F.lag(t).over(Window.partitionBy(*partition).orderBy(t, tb)))

    b = add_order_bucket(df, t, tb, num_buckets)
    last_per_bucket = b.groupBy(*partition, BUCKET).agg(F.max(t).alias("_bmax"))
    # one row per (partition, bucket): a hot flow has at most num_buckets rows here
    wb = Window.partitionBy(*partition).orderBy(BUCKET)
    stitch = last_per_bucket.select(*partition, BUCKET, F.lag("_bmax").over(wb).alias("_prev_last"))
    joined = b.join(stitch, on=[*partition, BUCKET], how="inner")
    w = Window.partitionBy(*partition, BUCKET).orderBy(t, tb)
    prev = F.coalesce(F.lag(t).over(w), F.col("_prev_last"))
    return finish(joined, prev).drop(BUCKET, "_prev_last")


def add_iat(
    df: DataFrame,
    partition: list[str] | None = None,
    order_by: tuple[str, str] = ("time", "no"),
    skew_safe: bool = True,
    num_buckets: int | None = None,
) -> DataFrame:
    """Per-flow inter-arrival time, first packet of a flow 0, stored as float32."""
    return add_gap(df, partition or ["flow_id"], order_by, "iat", True, skew_safe, num_buckets)


def iat_raw(df: DataFrame, order_by: tuple[str, str] = ("global_time", "no"), clip_hi: float = 0.1) -> DataFrame:
    """Gap to the previous packet in global time order, first 0, clipped to [0, clip_hi]."""
    g = add_gap(df, [], order_by, "iat_raw")
    return g.withColumn("iat_raw", F.least(F.greatest(F.col("iat_raw"), F.lit(0.0)), F.lit(clip_hi)))


def packet_features(
    df: DataFrame, iat_scope: str = "flow", skew_safe: bool = True, num_buckets: int | None = None
) -> DataFrame:
    """F6 = F1..F4 + W1. ``iat_scope`` "flow" (reference: flows of different captures
    interleave on capture-local time) or "capture_flow"."""
    parsed = parse_packets(df)
    part = ["flow_id"] if iat_scope == "flow" else ["capture_ord" if "capture_ord" in df.columns else "capture", "flow_id"]
    return add_iat(parsed, part, skew_safe=skew_safe, num_buckets=num_buckets)
