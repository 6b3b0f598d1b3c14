"""Registered queries: exploratory and dashboard aggregates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.functions.packet import time_label
from flowlens.operators import eda, summary
from flowlens.operators.packet_features import iat_raw
from flowlens.operators.sample import bootstrap_class_dist, portable_hash
from flowlens.plans import oracle as O
from flowlens.plans.queries_prep import TIMELINE, sql, timeline, training_packets
from flowlens.operators.windows import window_features
from flowlens.plans.registry import register
from flowlens.session import materialize

#: every packet of the timeline
EDA_PACKETS = TIMELINE + ["ds AS (SELECT * FROM timeline)"]
TRAIN = EDA_PACKETS + [O.feat_cte("ds", "tfeat"), O.windows_sql("tfeat", order="global_time", has_labels=True)]


def eda_packets(spark, sf):
    return timeline(spark, sf)


def train_windows(spark, sf):
    return materialize(window_features(training_packets(spark, sf)))


# ------------------------------------------------------------------ packets
@register("class_counts", sql(*EDA_PACKETS, final=f"""SELECT label, count(*) AS count,
    {O.CLASS_CASE.format(c='label')} AS class_name FROM ds GROUP BY label"""))
def q_class_counts(spark, sf):
    return eda.class_counts(eda_packets(spark, sf))


@register("packet_rate", sql(*EDA_PACKETS, final="""SELECT label, CAST(trunc(global_time) AS BIGINT) AS second,
    count(*) AS packets FROM ds GROUP BY ALL"""))
def q_packet_rate(spark, sf):
    return eda.packet_rate(eda_packets(spark, sf))


@register("length_hist", sql(*EDA_PACKETS, O.hist_sql("ds", "length", 50, ["label"], "h", True),
                             final="SELECT * FROM h"), ["density"])
def q_length_hist(spark, sf):
    return eda.length_hist(eda_packets(spark, sf))


@register("protocol_top10", sql(*EDA_PACKETS, final="""SELECT protocol, count(*) AS count FROM ds GROUP BY protocol
    ORDER BY count DESC, protocol NULLS LAST LIMIT 10"""))
def q_protocol_top10(spark, sf):
    return eda.protocol_top10(eda_packets(spark, sf))


@register("unique_src_per_s", sql(*EDA_PACKETS, final="""SELECT CAST(trunc(global_time) AS BIGINT) AS second,
    count(DISTINCT source) AS n_src FROM ds GROUP BY ALL"""))
def q_unique_src(spark, sf):
    return eda.unique_src_per_s(eda_packets(spark, sf))


IAT_RAW = """
gap AS (
  SELECT *, least(greatest(coalesce(global_time - lag(global_time) OVER (ORDER BY global_time, no), 0), 0), 0.1) AS iat_raw
  FROM ds
)"""


@register("iat_raw", sql(*EDA_PACKETS, IAT_RAW, final="SELECT no, label, global_time, iat_raw FROM gap"),
          ["global_time", "iat_raw"])
def q_iat_raw(spark, sf):
    return iat_raw(eda_packets(spark, sf)).select("no", "label", "global_time", "iat_raw")


@register("iat_raw_hist", sql(*EDA_PACKETS, IAT_RAW, O.hist_sql("gap", "iat_raw", 60, ["label"], "h", True),
                              final="SELECT * FROM h"), ["density"])
def q_iat_raw_hist(spark, sf):
    return eda.iat_raw_hist(iat_raw(eda_packets(spark, sf)))


# ------------------------------------------------------------------ windows
def _feature_hists_sql():
    ctes, finals = [], []
    for f, b, hi in eda.FEATURE_HISTS:
        expr = f"least(greatest(CAST({f} AS DOUBLE), 0.0), {hi})" if hi is not None else f"CAST({f} AS DOUBLE)"
        ctes.append(f"fh_{f} AS (SELECT Label, {expr} AS v FROM windows)")
        ctes.append(O.hist_sql(f"fh_{f}", "v", b, ["Label"], f"h_{f}", True))
        finals.append(f"SELECT *, '{f}' AS feature FROM h_{f}")
    return sql(*TRAIN, *ctes, final=" UNION ALL ".join(finals))


@register("feature_hists", _feature_hists_sql(), ["density"])
def q_feature_hists(spark, sf):
    return eda.feature_hists(train_windows(spark, sf))


@register("pkt_rate_box", sql(*TRAIN, """
bx AS (SELECT Label, least(greatest(pkt_rate, 0.0), 5000.0) AS v FROM windows),
bq AS (SELECT Label, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
       FROM bx GROUP BY Label)""", final="""SELECT bq.Label, q1, median, q3,
    min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS whisker_lo,
    max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_hi, count(*) AS n
    FROM bx JOIN bq USING (Label) GROUP BY bq.Label, q1, median, q3"""),
    ["q1", "median", "q3", "whisker_lo", "whisker_hi"])
def q_pkt_rate_box(spark, sf):
    return eda.pkt_rate_box(train_windows(spark, sf))


_KP = list(combinations(eda.KEY_FEATURES, 2))


@register("key_corr", sql(*TRAIN, O.corr_sql("windows", eda.KEY_FEATURES, _KP, "kc"),
                          final="SELECT f1, f2, corr FROM kc UNION ALL SELECT f2, f1, corr FROM kc UNION ALL "
                                + " UNION ALL ".join(f"SELECT '{f}', '{f}', 1.0" for f in eda.KEY_FEATURES)),
          ["corr"])
def q_key_corr(spark, sf):
    return eda.key_corr(train_windows(spark, sf))


_FC = FEATURE_COLS + ["Label"]
_FP = [(_FC[i], _FC[j]) for i in range(len(_FC)) for j in range(i)]


@register("full_corr", sql(*TRAIN, O.corr_sql("windows", _FC, _FP, "fc"), final="SELECT * FROM fc"), ["corr"])
def q_full_corr(spark, sf):
    return eda.full_corr(train_windows(spark, sf))


@register("label_leakage", sql(*TRAIN, O.corr_sql("windows", _FC, [(f, "Label") for f in FEATURE_COLS], "lc"),
                               final="""SELECT f1 AS feature, abs(corr) AS abs_corr, abs(corr) > 0.85 AS suspect
    FROM lc ORDER BY abs_corr DESC NULLS LAST, feature LIMIT 10"""), ["abs_corr"])
def q_label_leakage(spark, sf):
    return eda.label_leakage(train_windows(spark, sf))


_DESC = " UNION ALL ".join(
    f"""SELECT Label, '{f}' AS feature, round_even(avg(CAST({f} AS DOUBLE)), 3) AS mean,
        round_even(stddev_samp(CAST({f} AS DOUBLE)), 3) AS std, round_even(min(CAST({f} AS DOUBLE)), 3) AS min,
        round_even(max(CAST({f} AS DOUBLE)), 3) AS max, count(*) AS n FROM windows GROUP BY Label"""
    for f in eda.DESCRIBE_FEATURES)


@register("describe_by_class", sql(*TRAIN, final=_DESC), ["mean", "std", "min", "max"])
def q_describe(spark, sf):
    return eda.describe_by_class(train_windows(spark, sf))


# ------------------------------------------------------------------ dashboard summary
@register("summary_kpi", sql(*TRAIN, final="""SELECT count(*) AS total_windows, CAST(sum(pkt_count) AS BIGINT) AS total_packets,
    CAST(sum(CASE WHEN Label <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS attack_windows, count(DISTINCT Label) AS n_classes,
    CAST(printf('%.1f', CAST(sum(CASE WHEN Label <> 0 THEN 1 ELSE 0 END) * 100.0 / greatest(count(*), 1) AS DOUBLE)) AS DOUBLE) AS attack_pct
    FROM windows"""), ["attack_pct"])
def q_summary_kpi(spark, sf):
    return summary.summary_kpi(train_windows(spark, sf))


_CLS = " UNION ALL ".join(f"SELECT {k} AS class_id, '{v}' AS class_name" for k, v in sorted(CLASS_NAMES.items()))


@register("summary_class_dist", sql(*TRAIN, f"cls AS ({_CLS})", "wc AS (SELECT Label, count(*) AS c FROM windows GROUP BY Label)",
                                    final="""SELECT class_id, class_name, coalesce(c, 0) AS count,
    CAST(printf('%.1f', CAST(coalesce(c, 0) * 100.0 / greatest((SELECT count(*) FROM windows), 1) AS DOUBLE)) AS DOUBLE) AS pct
    FROM cls LEFT JOIN wc ON wc.Label = cls.class_id"""), ["pct"])
def q_summary_class_dist(spark, sf):
    return summary.summary_class_dist(train_windows(spark, sf))


@register("summary_stats", sql(*TRAIN, final=f"""SELECT Label, count(*) AS count,
    {', '.join(f'CAST(printf(\'%.4f\', CAST(sum(CAST({f} AS DECIMAL(38, 10))) AS DOUBLE) / count({f})) AS DOUBLE) AS {f}' for f in summary.SUMMARY_STAT_FEATURES)},
    {O.CLASS_CASE.format(c='Label')} AS class_name FROM windows WHERE Label IN (0, 1, 2, 3, 4) GROUP BY Label"""),
          summary.SUMMARY_STAT_FEATURES)
def q_summary_stats(spark, sf):
    return summary.summary_stats(train_windows(spark, sf))


def _summary_hists_sql():
    ctes, finals = [], []
    for f in summary.SUMMARY_HIST_FEATURES:
        ctes.append(f"""sh_{f}_cap AS (SELECT CASE WHEN count(*) > 10 THEN quantile_cont(CAST({f} AS DOUBLE), 0.98)
                        ELSE max(CAST({f} AS DOUBLE)) END AS cap FROM windows)""")
        ctes.append(f"""sh_{f} AS (SELECT Label, least(CAST({f} AS DOUBLE), cap) AS v FROM windows, sh_{f}_cap
                        WHERE Label IN (0, 1, 2, 3, 4))""")
        ctes.append(O.hist_sql(f"sh_{f}", "v", 30, ["Label"], f"shh_{f}"))
        finals.append(f"SELECT *, '{f}' AS feature, {O.CLASS_CASE.format(c='Label')} AS class_name FROM shh_{f}")
    return sql(*TRAIN, *ctes, final=" UNION ALL ".join(finals))


@register("summary_hists", _summary_hists_sql(), [])
def q_summary_hists(spark, sf):
    return summary.summary_hists(train_windows(spark, sf))


@register("summary_series", sql(*TRAIN, final=f"""SELECT window_idx, CAST(printf('%.3f', time_start) AS DOUBLE) AS t,
    CAST(printf('%.2f', pkt_rate) AS DOUBLE) AS pkt_rate, CAST(printf('%.4f', syn_ratio) AS DOUBLE) AS syn_ratio, {O.CLASS_CASE.format(c='Label')} AS label
    FROM windows ORDER BY (window_idx * 7919 + 42 * 104729) % 1000003, window_idx LIMIT 500"""),
          ["t", "pkt_rate", "syn_ratio"])
def q_summary_series(spark, sf):
    return summary.summary_series(train_windows(spark, sf), order=portable_hash("window_idx"))


@register("time_labels", sql(*TRAIN, final="""SELECT window_idx, time_start,
    CASE WHEN time_start > 1e8 THEN strftime(to_timestamp(time_start), '%H:%M:%S')
         ELSE printf('%.2f', time_start) || 's' END AS time_label FROM windows"""), ["time_start"])
def q_time_labels(spark, sf):
    return train_windows(spark, sf).select("window_idx", "time_start", time_label("time_start").alias("time_label"))


@register("bootstrap_class_dist")
def q_bootstrap(spark, sf):
    return bootstrap_class_dist(train_windows(spark, sf))
