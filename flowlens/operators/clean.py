"""Cleaning of raw packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_dest(df: DataFrame) -> DataFrame:
    """Drop rows without a destination."""
    return df.where(F.col("destination").isNotNull())


def coerce_time(c: Column | str = "time") -> Column:
    """Numeric time, invalid -> null (try_cast: ANSI-safe)."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def coerce_length(c: Column | str = "length") -> Column:
    """Numeric length via float, truncated to int; invalid or overflow -> null."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("float").try_cast("int")


def clean_packets(df: DataFrame, length_policy: str = "zero") -> DataFrame:
    """P5 = P1 + P2 + P3 + P4.

    length_policy "zero": an invalid length becomes 0 and the row is kept;
    "drop": the row is dropped. Rows without a valid time are dropped. Order is not
    materialised; consumers order by (time, no).
    """
    if length_policy not in ("zero", "drop"):
        raise ValueError("length_policy must be 'zero' or 'drop'")
    out = clean_dest(df).withColumn("time", coerce_time("time"))
    length = coerce_length("length")
    if length_policy == "zero":
        out = out.withColumn("length", F.coalesce(length, F.lit(0)))
    else:
        out = out.withColumn("length", length).where(F.col("length").isNotNull())
    return out.where(F.col("time").isNotNull() & ~F.isnan("time")).withColumn("info", F.coalesce(F.col("info"), F.lit("nan")))
