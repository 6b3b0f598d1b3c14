"""Registered queries: sources, cleaning, labels, timeline, sampling, rank (S, P, L, U, D, W0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.constants import HOSTS
from flowlens.operators.clean import clean_dest, clean_packets
from flowlens.operators.label import (
    capture_counts,
    enrich_hosts,
    label_captures,
    label_distribution,
    label_rule,
)
from flowlens.operators.packet_features import packet_features, parse_packets
from flowlens.operators.rank import packet_rank
from flowlens.operators.sample import downsample, portable_hash
from flowlens.operators.timeline import merge_timeline
from flowlens.operators.windows import window_features
from flowlens.plans import oracle as O
from flowlens.plans.registry import register
from flowlens.session import materialize
from flowlens.sources.hosts import host_dim
from flowlens.sources.packets import capture_frames_from_events, packets_from_events, read_table, scan_nrows

TEST_RULES = [O.TEST_RULE]
PACKET_DOUBLES = ["time", "local_time"]


def clean(spark: SparkSession, sf_dir: str, length_policy: str = "zero") -> DataFrame:
    return clean_packets(packets_from_events(spark, sf_dir), length_policy)


def timeline(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """Captures (each scanning its own time range) -> clean -> label -> merged timeline,
    the union written once to the shared checkpoint folder."""
    caps = capture_frames_from_events(read_table(spark, sf_dir, "events"), clean_packets)
    return merge_timeline(label_captures(caps, TEST_RULES), materialize if materialized else None)


def training_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged, labelled timeline -> packet features of every packet."""
    return materialize(packet_features(timeline(spark, sf_dir)))


def training_windows_plan(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The public end-to-end plan (flowlens.plans.pipeline) on the adapted captures."""
    from flowlens.plans.pipeline import build_training_windows

    ev = read_table(spark, sf_dir, "events")
    caps = capture_frames_from_events(ev)
    return build_training_windows(caps, TEST_RULES, **kw)


BASE = [O.PACKETS, O.CLEAN_ZERO]
#: the argument that the scan_nrows query passes (the feature is the row limit)
SCAN_ROWS = 2500
TIMELINE = BASE + [O.labeled_ctes()]


def sql(*ctes: str, final: str) -> str:
    return O.with_ctes(*ctes, final=final)


@register("scan_packets", sql(*BASE[:1], final="SELECT * FROM packets_x"), PACKET_DOUBLES)
def q_scan(spark, sf):
    return packets_from_events(spark, sf)


@register("scan_nrows", sql(*BASE[:1], final=f"SELECT * FROM packets_x WHERE no <= {SCAN_ROWS}"), PACKET_DOUBLES)
def q_scan_nrows(spark, sf):
    return scan_nrows(packets_from_events(spark, sf), SCAN_ROWS)


@register("clean_dest", sql(*BASE[:1], final="SELECT * FROM packets_x WHERE destination IS NOT NULL"), PACKET_DOUBLES)
def q_clean_dest(spark, sf):
    return clean_dest(packets_from_events(spark, sf))


@register("clean_packets", sql(*BASE, final="SELECT * FROM clean"), PACKET_DOUBLES)
def q_clean(spark, sf):
    return clean(spark, sf)


CLEAN_DROP = """
clean AS (
  SELECT no, TRY_CAST(time AS DOUBLE) AS time, source, destination, protocol,
         TRY_CAST(trunc(TRY_CAST(length AS FLOAT)) AS INTEGER) AS length,
         coalesce(info, 'nan') AS info, capture, local_time
  FROM packets_x
  WHERE destination IS NOT NULL AND TRY_CAST(time AS DOUBLE) IS NOT NULL
    AND TRY_CAST(trunc(TRY_CAST(length AS FLOAT)) AS INTEGER) IS NOT NULL
)"""


@register("clean_packets_drop", sql(O.PACKETS, CLEAN_DROP, final="SELECT * FROM clean"), PACKET_DOUBLES)
def q_clean_drop(spark, sf):
    return clean(spark, sf, "drop")


@register(
    "label_rule",
    sql(*BASE, final=f"""SELECT *, CASE WHEN source = '{O.TEST_RULE[0]}' AND destination = '{O.TEST_RULE[1]}'
        AND local_time >= {O.TEST_RULE[2]} AND local_time <= {O.TEST_RULE[3]} THEN 1 ELSE 0 END AS label
        FROM clean WHERE capture = 0"""),
    PACKET_DOUBLES,
)
def q_label_rule(spark, sf):
    return label_rule(clean(spark, sf).where(F.col("capture") == 0), TEST_RULES, time_col="local_time")


@register("labeled_timeline", sql(*TIMELINE, final="SELECT * FROM timeline"), ["time", "global_time"])
def q_timeline(spark, sf):
    return timeline(spark, sf)


@register(
    "label_distribution",
    sql(*TIMELINE, final=f"""SELECT label, {O.CLASS_CASE.format(c='label')} AS class_name, count(*) AS count,
        count(*) * 100.0 / sum(count(*)) OVER () AS pct FROM timeline GROUP BY label"""),
    ["pct"],
)
def q_label_distribution(spark, sf):
    return label_distribution(timeline(spark, sf))


@register("capture_counts", sql(*TIMELINE, final="SELECT capture_name, count(*) AS count FROM timeline GROUP BY capture_name"))
def q_capture_counts(spark, sf):
    return capture_counts(timeline(spark, sf))


HOSTS_SQL = "(VALUES " + ", ".join(
    f"('{h}', '{ip}', '{mac}', {sw}, '{role}')" for h, ip, mac, sw, role in HOSTS
) + ") AS hosts(hostname, ip, mac, switch_idx, role)"


@register(
    "enrich_hosts",
    sql(*BASE, final=f"""SELECT c.*, s.hostname AS src_host, s.switch_idx AS src_switch, s.role AS src_role,
        d.hostname AS dst_host, d.switch_idx AS dst_switch, d.role AS dst_role
        FROM clean c LEFT JOIN {HOSTS_SQL.replace('AS hosts', 'AS s')} ON c.source = s.ip
        LEFT JOIN {HOSTS_SQL.replace('AS hosts', 'AS d')} ON c.destination = d.ip"""),
    PACKET_DOUBLES,
)
def q_enrich_hosts(spark, sf):
    return enrich_hosts(clean(spark, sf), host_dim(spark))


DS_PARAMS = dict(sample_frac=0.5, min_keep=100, labels=[0, 1, 4])


@register(
    "downsample",
    sql(*TIMELINE, O.downsample_cte("timeline", "ds", 0.5, 100, [0, 1, 4]), final="SELECT * FROM ds"),
    ["time", "global_time"],
)
def q_downsample(spark, sf):
    return downsample(timeline(spark, sf), **DS_PARAMS, order=portable_hash("no"))


@register(
    "downsample_counts",
    sql(*TIMELINE, O.downsample_cte("timeline", "ds", 0.1, 500000, [0, 1, 4]),
        final="SELECT label, count(*) AS count FROM ds GROUP BY label"),
)
def q_downsample_counts(spark, sf):
    return downsample(timeline(spark, sf)).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


PARSE_COLS = "no, time, source, destination, length, capture, local_time, proto_num, src_port, dst_port, " \
             "flag_SYN, flag_ACK, flag_FIN, flag_RST, flag_PSH, flag_URG, flow_id"


@register("parse_packets", sql(*BASE, O.feat_cte(), final=f"SELECT {PARSE_COLS} FROM feat_f"), PACKET_DOUBLES)
def q_parse(spark, sf):
    return parse_packets(clean(spark, sf))


@register("packet_features", sql(*BASE, O.feat_cte(), final=f"SELECT {PARSE_COLS}, iat FROM feat"),
          PACKET_DOUBLES + ["iat"])
def q_packet_features(spark, sf):
    return packet_features(clean(spark, sf))


@register("packet_features_plain_iat", sql(*BASE, O.feat_cte(), final=f"SELECT {PARSE_COLS}, iat FROM feat"),
          PACKET_DOUBLES + ["iat"])
def q_packet_features_plain(spark, sf):
    return packet_features(clean(spark, sf), skew_safe=False)


@register("packet_rank", sql(*BASE, final="SELECT no, time, row_number() OVER (ORDER BY time, no) - 1 AS rank FROM clean"),
          ["time"])
def q_rank(spark, sf):
    return packet_rank(clean(spark, sf).select("no", "time"), order_by=("time", "no"))


@register(
    "rank_by_label",
    sql(*TIMELINE, final="""SELECT no, label, global_time,
        row_number() OVER (PARTITION BY label ORDER BY global_time, no) - 1 AS rank FROM timeline"""),
    ["global_time"],
)
def q_rank_by_label(spark, sf):
    return packet_rank(timeline(spark, sf).select("no", "label", "global_time"), order_by=("global_time", "no"),
                       keys=["label"])


TRAIN_WINDOWS_SQL = sql(
    *TIMELINE, "ds AS (SELECT * FROM timeline)",
    O.feat_cte("ds", "tfeat"), O.windows_sql("tfeat", order="global_time", has_labels=True),
    final="SELECT * FROM windows",
)


@register("training_windows", TRAIN_WINDOWS_SQL, O.WINDOW_DOUBLES)
def q_training_windows(spark, sf):
    return window_features(training_packets(spark, sf))


@register("training_windows_pipeline", TRAIN_WINDOWS_SQL, O.WINDOW_DOUBLES)
def q_training_windows_pipeline(spark, sf):
    """The same windows through the public plan function (its own checkpoints)."""
    return training_windows_plan(spark, sf)


@register("packet_features_capture_flow",
          sql(*TIMELINE, O.feat_cte("timeline", "cf", iat_part="capture_ord, flow_id"),
              final="SELECT no, capture_ord, flow_id, time, iat FROM cf"), ["time", "iat"])
def q_packet_features_capture_flow(spark, sf):
    """W1 with iat_scope="capture_flow": flows of different captures do not interleave."""
    return packet_features(timeline(spark, sf), iat_scope="capture_flow").select("no", "capture_ord", "flow_id", "time", "iat")


@register("packet_features_timeline",
          sql(*TIMELINE, O.feat_cte("timeline", "tf"), final="SELECT no, capture_ord, flow_id, time, iat FROM tf"),
          ["time", "iat"])
def q_packet_features_timeline(spark, sf):
    """W1 with the reference scope on the merged timeline (capture-local times interleave)."""
    return packet_features(timeline(spark, sf)).select("no", "capture_ord", "flow_id", "time", "iat")
