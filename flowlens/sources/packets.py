"""Packet sources.

The raw packet table (T1) has the columns
``no bigint, time <string|double>, source, destination, protocol, length string, info``.
``no`` is the 1-based file row number and is kept as the tie-breaker of every ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: strings a pandas CSV reader treats as missing; normalised to null at the scan.
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _na_to_null(c: Column) -> Column:
    return F.when(c.isin(NA_STRINGS), F.lit(None).cast("string")).otherwise(c)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_packets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Scan a packet CSV as a capture tool exports it into T1.

    Columns are found by their names in the header, in any order and among others; files of one path must agree
    on it (a file that doesn't raises an error). ``No.`` may be missing (null). Every field is read as text and
    coerced later with try_cast, so one bad value never aborts the scan. A quote inside a field is doubled.
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("quote", '"').option("escape", '"').csv(path))
    no = F.col("`No.`").try_cast("bigint") if "No." in raw.columns else F.lit(None).cast("bigint")
    return raw.select(
        no.alias("no"),
        _na_to_null(F.col("Time")).alias("time"),
        _na_to_null(F.col("Source")).alias("source"),
        _na_to_null(F.col("Destination")).alias("destination"),
        _na_to_null(F.col("Protocol")).alias("protocol"),
        _na_to_null(F.col("Length")).alias("length"),
        F.col("Info").alias("info"),
    )


def read_packets_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S1 for Parquet captures already in T1 layout (column pruning/pushdown by Catalyst)."""
    return spark.read.parquet(path).select("no", "time", "source", "destination", "protocol", "length", "info")


def scan_nrows(packets: DataFrame, nrows: int | None) -> DataFrame:
    """The first ``nrows`` file rows, before cleaning.

    ``no`` is the file row number, so the cap is a plain predicate that Parquet can
    push down, and it is deterministic (``limit`` is not, on a distributed scan).
    """
    if nrows is None:
        return packets
    return packets.where(F.col("no") <= F.lit(int(nrows)))


# ---------------------------------------------------------------------------
# Test adapter: the driver's `events` table re-read as a packet capture.
# Same definition as the DuckDB oracle SQL in flowlens.plans.oracle.
# ---------------------------------------------------------------------------

# FIXED VALUES: event type -> protocol display name.
EVENT_PROTOCOL = {"click": "TCP", "view": "UDP", "purchase": "HTTP", "signup": "DNS", "error": "SSDP"}

# Seconds per capture slice when the events month is cut into four captures.
CAPTURE_SECONDS = 648000


def events_as_packets(events: DataFrame) -> DataFrame:
    """Adapter `events` -> raw packets (T1 plus helper columns).

    Columns: no, time (double seconds from 2024-01-01), source, destination,
    protocol, length (raw text, 'bad' for some rows), info, capture (0..3),
    local_time (time within its capture).
    """
    # a column of its own, so the JSON text is parsed once a row and not once a use
    events = events.withColumn("_k", F.get_json_object("props", "$.k").cast("bigint"))
    k = F.col("_k")
    uid = F.col("user_id")
    et = F.col("event_type")
    # timestampdiff on TIMESTAMP_NTZ is independent of the session time zone.
    time = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / F.lit(1e6)
    length = (F.floor("value").cast("int") + F.lit(40))
    proto = F.lit(None).cast("string")
    for e, p in EVENT_PROTOCOL.items():
        proto = F.when(et == e, F.lit(p)).otherwise(proto)
    click_flag = (
        F.when(k % 3 == 0, F.lit(" [SYN] Seq=0"))
        .when(k % 3 == 1, F.lit(" [SYN, ACK] Seq=0"))
        .otherwise(F.lit(" [FIN, ACK] Seq=1"))
    )
    info = (
        F.when(et == "click", F.concat((uid + 40000).cast("string"), F.lit(" > "), k.cast("string"), click_flag))
        .when(et == "purchase", F.concat((uid + 40000).cast("string"), F.lit(" > 80 [PSH, ACK] Len=9")))
        .when(et == "error", F.concat((uid + 40000).cast("string"), F.lit(" > 22 [RST] Seq=1")))
        .when(et == "view", F.concat((uid + 50000).cast("string"), F.lit("  >  "), k.cast("string"), F.lit(" Len=5")))
        .when(et == "signup", F.lit("Standard query A example"))
    )
    capture = F.least(F.lit(3), F.floor(F.col("time") / F.lit(CAPTURE_SECONDS)).cast("int"))
    return (
        events.select(
            (F.col("event_id") + 1).alias("no"),
            time.alias("time"),
            F.concat(F.lit("10.0.0."), (uid % 20 + 1).cast("string")).alias("source"),
            F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("10.0.0."), (k % 20 + 1).cast("string")))
            .alias("destination"),
            proto.alias("protocol"),
            F.when(F.col("event_id") % 89 == 0, F.lit("bad")).otherwise(length.cast("string")).alias("length"),
            info.alias("info"),
        )
        .withColumn("capture", capture)
        .withColumn("local_time", F.col("time") - F.col("capture") * F.lit(float(CAPTURE_SECONDS)))
    )


def packets_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_packets(read_table(spark, sf_dir, "events"))


def capture_frames_from_events(events: DataFrame, clean=None) -> list[tuple[str, DataFrame]]:
    """The four captures of the adapter, each scanning only its own time range.

    The range predicate is stated on the raw ``ts`` column so Parquet row-group
    statistics can skip the other captures' data (PushedFilters); the exact capture
    test on the derived column is kept as well.
    """
    from flowlens.constants import CAPTURE_ORDER

    start = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
    out = []
    for i, name in enumerate(CAPTURE_ORDER):
        cond = F.col("ts") >= F.expr(f"{start} + make_dt_interval(0, 0, 0, {i * CAPTURE_SECONDS})")
        if i < len(CAPTURE_ORDER) - 1:
            cond = cond & (F.col("ts") < F.expr(f"{start} + make_dt_interval(0, 0, 0, {(i + 1) * CAPTURE_SECONDS})"))
        pk = events_as_packets(events.where(cond))
        if clean is not None:
            pk = clean(pk)
        frame = pk.where(F.col("capture") == i).drop("time", "capture").withColumnRenamed("local_time", "time")
        out.append((name, frame))
    return out
