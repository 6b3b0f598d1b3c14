"""Labelling and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.constants import CAPTURE_CONST_LABEL, DDOS_DST, DDOS_SRC, DDOS_T_END, DDOS_T_START
from flowlens.functions.packet import class_name

# (source, destination, first second, last second, label)
DEFAULT_RULES = [(DDOS_SRC, DDOS_DST, DDOS_T_START, DDOS_T_END, 1)]


def label_rule(df: DataFrame, rules: Sequence[tuple] = DEFAULT_RULES, default: int = 0, time_col: str = "time") -> DataFrame:
    """L1: label = first rule whose source, destination and inclusive time range match, else ``default``.

    Rules are a literal list (a handful of rows), so they compile into one native CASE
    expression: no join, no shuffle.
    """
    expr = F.lit(default)
    for src, dst, t0, t1, lab in reversed(list(rules)):
        cond = (
            (F.col("source") == F.lit(src))
            & (F.col("destination") == F.lit(dst))
            & (F.col(time_col) >= F.lit(float(t0)))
            & (F.col(time_col) <= F.lit(float(t1)))
        )
        expr = F.when(cond, F.lit(lab)).otherwise(expr)
    return df.withColumn("label", F.coalesce(expr, F.lit(default)).cast("int"))


def label_const(df: DataFrame, label: int) -> DataFrame:
    """L2: constant label for a pure capture."""
    return df.withColumn("label", F.lit(int(label)).cast("int"))


def label_captures(
    captures: Sequence[tuple[str, DataFrame]], rules: Sequence[tuple] = DEFAULT_RULES
) -> list[tuple[str, DataFrame]]:
    """L3: label every named capture; the mixed capture by rule, the others by constant."""
    out = []
    for name, df in captures:
        if name in CAPTURE_CONST_LABEL:
            out.append((name, label_const(df, CAPTURE_CONST_LABEL[name])))
        else:
            out.append((name, label_rule(df, rules)))
    return out


def label_distribution(df: DataFrame, key: str = "label") -> DataFrame:
    """Rows and share (%) per label. The total comes from a one-row aggregate
    (broadcast by construction), not from a second scan on the driver."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    return (
        counts.crossJoin(F.broadcast(total))
        .select(key, class_name(F.col(key)).alias("class_name"), "count",
                (F.col("count") * 100.0 / F.col("_total")).alias("pct"))
    )


def capture_counts(df: DataFrame) -> DataFrame:
    """Packets per capture."""
    return df.groupBy("capture_name").agg(F.count(F.lit(1)).alias("count"))


def enrich_hosts(df: DataFrame, hosts: DataFrame, src: str = "source", dst: str = "destination") -> DataFrame:
    """Attach host name, switch and role of both endpoints (two broadcast left
    joins; the host table has a fixed 20 rows)."""
    h = hosts.select("ip", "hostname", "switch_idx", "role")
    s = F.broadcast(h.select(F.col("ip").alias("_sip"), F.col("hostname").alias("src_host"),
                             F.col("switch_idx").alias("src_switch"), F.col("role").alias("src_role")))
    d = F.broadcast(h.select(F.col("ip").alias("_dip"), F.col("hostname").alias("dst_host"),
                             F.col("switch_idx").alias("dst_switch"), F.col("role").alias("dst_role")))
    return (
        df.join(s, F.col(src) == F.col("_sip"), "left")
        .join(d, F.col(dst) == F.col("_dip"), "left")
        .drop("_sip", "_dip")
    )
