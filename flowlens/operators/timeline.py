"""Set operations and the shared timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_captures(captures: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Bag union of the named captures, tagged with name and timeline order."""
    parts = [
        df.withColumn("capture_name", F.lit(name)).withColumn("capture_ord", F.lit(i).cast("int"))
        for i, (name, df) in enumerate(captures)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def capture_offsets(merged: DataFrame) -> DataFrame:
    """Offsets of each capture on the shared axis: 0 for the first, then
    ``offset_{i+1} = (max(time_i) + offset_i) + 1.0`` in capture order.

    Computed on the per-capture maxima (one row per capture), folded in order with the
    same floating-point operations as the sequential definition.
    """
    maxima = merged.groupBy("capture_ord").agg(F.max("time").alias("m"))
    offs = maxima.agg(F.array_sort(F.collect_list(F.struct("capture_ord", "m"))).alias("ms")).select(
        F.aggregate(
            "ms",
            F.struct(F.array().cast("array<struct<capture_ord:int,off:double>>").alias("out"), F.lit(0.0).alias("next")),
            lambda acc, s: F.struct(
                F.concat(acc["out"], F.array(F.struct(s["capture_ord"].alias("capture_ord"), acc["next"].alias("off")))).alias("out"),
                ((s["m"] + acc["next"]) + F.lit(1.0)).alias("next"),
            ),
        )["out"].alias("o")
    )
    return offs.select(F.explode("o").alias("x")).select("x.capture_ord", "x.off")


def global_timeline(merged: DataFrame) -> DataFrame:
    """``global_time = time + offset(capture)``. The offsets table has one row per
    capture (a fixed, small list), so it is broadcast."""
    offs = F.broadcast(capture_offsets(merged))
    return merged.join(offs, "capture_ord", "left").withColumn("global_time", F.col("time") + F.col("off")).drop("off")


def merge_timeline(captures: Sequence[tuple[str, DataFrame]], materialize=None) -> DataFrame:
    """U1 + U2. The global sort (U3) is not materialised: consumers order by
    (global_time, no), e.g. the rank operator or a sink's orderBy.

    ``materialize`` (e.g. ``flowlens.session.materialize``) writes the union once, so
    the per-capture maxima and every later pass read it instead of the sources."""
    merged = merge_captures(captures)
    if materialize is not None:
        merged = materialize(merged)
    return global_timeline(merged)


def global_sort(df: DataFrame) -> DataFrame:
    """U3 at a sink: a distributed range-partitioned sort."""
    return df.orderBy("global_time", "capture_ord", "no")
