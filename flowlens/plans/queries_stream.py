"""Registered queries: flow statistics (P9, F10-F12, S9) and streaming operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from flowlens.operators.flows import flow_statistics, flows_from_packets
from flowlens.operators.packet_features import parse_packets
from flowlens.operators.rank import packet_rank
from flowlens.plans import oracle as O
from flowlens.plans.queries_prep import clean, timeline
from flowlens.plans import queries_eval as _EV
from flowlens.plans import queries_prep as _PREP
from flowlens.plans.registry import register
from flowlens.session import materialize, shared_path
from flowlens.streaming import streams as X

FLOWS = f"""
fe AS (
  SELECT CAST(floor(time / 10.0) AS BIGINT) AS reply_id, source AS ipv4_src, destination AS ipv4_dst,
         CAST(proto_num AS INTEGER) AS ip_proto, src_port AS sport, dst_port AS dport,
         count(*) AS packet_count, CAST(sum(length) AS BIGINT) AS byte_count, max(time) - min(time) AS d
  FROM feat_f GROUP BY ALL
),
fs AS (
  SELECT (reply_id + 1) * 10.0 AS timestamp, CAST(1 AS BIGINT) AS datapath_id,
         ipv4_src || CAST(CASE ip_proto WHEN 6 THEN sport WHEN 17 THEN sport ELSE 0 END AS VARCHAR) || ipv4_dst
           || CAST(CASE ip_proto WHEN 6 THEN dport WHEN 17 THEN dport ELSE 0 END AS VARCHAR) || CAST(ip_proto AS VARCHAR) AS flow_id,
         ipv4_src AS ip_src, CASE ip_proto WHEN 6 THEN sport WHEN 17 THEN sport ELSE 0 END AS tp_src,
         ipv4_dst AS ip_dst, CASE ip_proto WHEN 6 THEN dport WHEN 17 THEN dport ELSE 0 END AS tp_dst, ip_proto,
         CASE WHEN ip_proto = 1 THEN 0 ELSE -1 END AS icmp_code, CASE WHEN ip_proto = 1 THEN 8 ELSE -1 END AS icmp_type,
         CAST(floor(d) AS BIGINT) AS flow_duration_sec, CAST(trunc((d - floor(d)) * 1e9) AS BIGINT) AS flow_duration_nsec,
         0 AS idle_timeout, 0 AS hard_timeout, 0 AS flags, packet_count, byte_count,
         CASE WHEN floor(d) = 0 OR trunc((d - floor(d)) * 1e9) = 0 THEN 0.0 ELSE packet_count / floor(d) END AS packet_count_per_second,
         CASE WHEN floor(d) = 0 OR trunc((d - floor(d)) * 1e9) = 0 THEN 0.0 ELSE packet_count / trunc((d - floor(d)) * 1e9) END AS packet_count_per_nsecond,
         CASE WHEN floor(d) = 0 OR trunc((d - floor(d)) * 1e9) = 0 THEN 0.0 ELSE byte_count / floor(d) END AS byte_count_per_second,
         CASE WHEN floor(d) = 0 OR trunc((d - floor(d)) * 1e9) = 0 THEN 0.0 ELSE byte_count / trunc((d - floor(d)) * 1e9) END AS byte_count_per_nsecond,
         0 AS label
  FROM fe WHERE ip_proto <> 0
)"""


STREAM_THREATS = """
thr0 AS (
  SELECT '10.0.0.' || CAST(e.user_id % 20 + 1 AS VARCHAR) AS key, event_id AS window_idx,
         (epoch_us(pn.ts) - 1704067200000000) / 1e6 AS time_start, prediction, confidence
  FROM pn JOIN events e USING (event_id) WHERE prediction <> 'Normal'
),
thr AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY time_start, window_idx) - 1 AS r FROM thr0),
thn AS (
  SELECT thr.*, (SELECT count(*) FROM thr t2 WHERE t2.key = thr.key AND t2.time_start < thr.time_start + 3.0) AS nx,
         (SELECT count(*) FROM thr t3 WHERE t3.key = thr.key) AS n
  FROM thr
),
chain(key, r) AS (SELECT DISTINCT key, 0 FROM thr UNION ALL
                  SELECT thn.key, thn.nx FROM thn JOIN chain ON thn.key = chain.key AND thn.r = chain.r WHERE thn.nx < thn.n)"""


def flows(spark, sf):
    return flows_from_packets(parse_packets(clean(spark, sf)))


@register("flow_statistics", O.with_ctes(O.PACKETS, O.CLEAN_ZERO, O.feat_cte(), FLOWS, final="SELECT * FROM fs"),
          ["timestamp", "packet_count_per_second", "packet_count_per_nsecond", "byte_count_per_second",
           "byte_count_per_nsecond"])
def q_flow_statistics(spark, sf):
    return flow_statistics(flows(spark, sf))


def _scratch(spark, name):
    return shared_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


def _write_in_order(df, base, order_col, slices=4):
    """Stream input: the table as time-ordered files, written one after another so that
    file modification order equals time order (in-order arrival)."""
    r = packet_rank(df.withColumn("_tb", F.xxhash64(*df.columns)), order_by=(order_col, "_tb"), rank_col="_r",
                    total_col="_n")
    b = r.withColumn("_slice", (F.floor(F.col("_r") * slices / F.col("_n")) + 1).cast("int")).drop("_r", "_n", "_tb")
    for i in range(1, slices + 1):
        b.where(F.col("_slice") == i).drop("_slice").write.mode("overwrite").parquet(os.path.join(base, f"part_{i:03d}"))
    return df.schema


def _replay(spark, df, order_col, advance, name, slices=4, closing=None):
    """Replay ``df`` as files arriving in time order: slice k is written (in parallel), then ``advance`` runs the
    streaming query over what has arrived and stops; the next slice restarts it from its checkpoint. ``closing``
    holds rows that arrive after all others. Returns what the last run returned."""
    base = _scratch(spark, f"{name}-in")
    r = packet_rank(df.withColumn("_tb", F.xxhash64(*df.columns)), order_by=(order_col, "_tb"), rank_col="_r",
                    total_col="_n")
    sliced = r.withColumn("_slice", (F.floor(F.col("_r") * slices / F.col("_n")) + 1).cast("int")).drop("_r", "_n", "_tb")
    sliced = materialize(sliced)
    pieces = [sliced.where(F.col("_slice") == i).drop("_slice") for i in range(1, slices + 1)]
    for i, piece in enumerate(pieces + ([] if closing is None else [closing]), 1):
        piece.write.parquet(os.path.join(base, f"part_{i:03d}"))
        out = advance(spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(base))
    return out


def _stream_in_order(spark, df, order_col, build, name, slices=4, mode="append", closing=None):
    """``_replay`` into a file sink; every restart exercises recovery from the checkpoint."""
    out, ck = _scratch(spark, f"{name}-out"), _scratch(spark, f"{name}-ck")
    _replay(spark, df, order_col, lambda src: X.run_to_table(build(src), out, ck, mode), name, slices, closing)
    return spark.read.parquet(out)


def _stream_source(spark, base, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
            .parquet(base))


@register("stream_count_windows",
          O.with_ctes(O.PACKETS, O.CLEAN_ZERO, O.feat_cte(iat_part="source, flow_id"), O.windows_sql("feat", key="source"),
                      final="SELECT * FROM windows"), O.WINDOW_DOUBLES)
def q_stream_windows(spark, sf):
    """Count windows per source over the packets arriving as time-ordered files; equals the
    batch windows of each source (tests/test_streaming.py)."""
    parsed = parse_packets(clean(spark, sf))
    folder = _scratch(spark, "x1")
    return _replay(spark, parsed, "time", lambda src: X.stream_count_windows(src, folder, key="source"), "x1")


@register("stream_alerts", "WITH RECURSIVE " + O.with_ctes(_EV.SCORED, _EV.PRED, STREAM_THREATS, final="""SELECT key,
    window_idx, time_start, prediction, confidence, row_number() OVER (PARTITION BY key ORDER BY time_start, window_idx) AS alert_no
    FROM thn WHERE (key, r) IN (SELECT key, r FROM chain)""")[len("WITH "):], ["time_start", "confidence"])
def q_stream_alerts(spark, sf):
    """Throttled alerts per source over the scored events stream (3 s of event time per source)."""
    from flowlens.plans.queries_eval import predictions
    from flowlens.sources.packets import read_table

    source = read_table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("10.0.0."), (F.col("user_id") % 20 + 1).cast("string")).alias("key"))
    p = predictions(spark, sf).join(source, "event_id").select(
        "key", F.col("event_id").alias("window_idx"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").cast("double").__truediv__(1e6)
        .alias("time_start"), "prediction", "confidence")
    return _stream_in_order(spark, p, "time_start", X.stream_alerts, "x3")


@register("stream_packet_rate", O.with_ctes(*_PREP.TIMELINE, final="""
      SELECT CAST(floor(global_time) AS BIGINT) AS second, label, count(*) AS packets,
             count(DISTINCT source) AS n_src_approx
      FROM timeline GROUP BY 1, 2"""))
def q_stream_packet_rate(spark, sf):
    """1-second tumbling windows with a 10 s watermark over the labelled timeline stream,
    files in time order. A last row, a minute later and without a class, closes the stream: it moves the
    watermark past every second of the table and is not emitted itself."""
    t = timeline(spark, sf).select("no", "global_time", "source", "label")
    end = t.agg((F.max("global_time") + 60.0).alias("global_time")).select(
        F.lit(None).cast("bigint").alias("no"), "global_time", F.lit(None).cast("string").alias("source"),
        F.lit(None).cast(t.schema["label"].dataType).alias("label"))
    res = _stream_in_order(spark, t, "global_time", X.stream_packet_rate, "x5", closing=end)
    return res.select(F.unix_seconds("second_start").alias("second"), "label", "packets",
                                          "n_src_approx")


@register("stream_flow_stats", O.with_ctes(O.PACKETS, O.CLEAN_ZERO, O.feat_cte(), FLOWS, final="SELECT * FROM fs"),
          ["timestamp", "packet_count_per_second", "packet_count_per_nsecond", "byte_count_per_second",
           "byte_count_per_nsecond"])
def q_stream_flow_stats(spark, sf):
    """Flow statistics over a stream of flow-counter entries (stateless, file sink)."""
    e = flows(spark, sf)
    return _stream_in_order(spark, e, "reply_id", X.stream_flow_stats, "x6")


@register("stream_metrics", O.with_ctes(_EV.SCORED, _EV.PRED, final="SELECT prediction, count(*) AS count FROM pn GROUP BY prediction"))
def q_stream_metrics(spark, sf):
    """Running counts per predicted class, complete mode, read back after the stream."""
    from flowlens.plans.queries_eval import predictions

    p = predictions(spark, sf).select(
        "event_id", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").alias("t_us"), "prediction")
    base = _scratch(spark, "x4-in")
    schema = _write_in_order(p, base, "t_us")
    return X.run_complete(X.stream_metrics(_stream_source(spark, base, schema)), _scratch(spark, "x4-out"),
                          _scratch(spark, "x4-ck"))


THREATS = """
thr0 AS (
  SELECT 'events' AS key, event_id AS window_idx, (epoch_us(ts) - 1704067200000000) / 1e6 AS time_start, prediction
  FROM pn WHERE prediction <> 'Normal'
),
thr AS (SELECT *, row_number() OVER (ORDER BY time_start, window_idx) - 1 AS r FROM thr0),
thn AS (
  SELECT thr.*, (SELECT count(*) FROM thr t2 WHERE t2.time_start < thr.time_start + 3.0) AS nx,
         (SELECT count(*) FROM thr) AS n
  FROM thr
),
chain(r) AS (SELECT 0 UNION ALL SELECT thn.nx FROM thn JOIN chain ON thn.r = chain.r WHERE thn.nx < thn.n)"""


def _threat_rows(spark, sf):
    from flowlens.plans.queries_eval import predictions

    return predictions(spark, sf).select(
        F.lit("events").alias("key"), F.col("event_id").alias("window_idx"),
        (F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / F.lit(1e6)).alias("time_start"),
        "prediction")


@register("alert_throttle", "WITH RECURSIVE " + O.with_ctes(_EV.SCORED, _EV.PRED, THREATS, final="""SELECT key, window_idx, time_start, prediction,
    row_number() OVER (ORDER BY time_start, window_idx) AS alert_no FROM thn WHERE r IN (SELECT r FROM chain)""")[len("WITH "):],
          ["time_start"])
def q_alert_throttle(spark, sf):
    """W7 batch: greedy 3-second alert throttle by pointer doubling (equals the X3 stream)."""
    from flowlens.operators.throttle import alert_throttle

    return alert_throttle(_threat_rows(spark, sf))
