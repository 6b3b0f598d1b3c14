"""Registered queries: decision rules, evaluation tables, replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES
from flowlens.functions.packet import np_round
from flowlens.operators import decide as D
from flowlens.operators import evaluate as EV
from flowlens.operators import replay as R
from flowlens.plans import oracle as O
from flowlens.plans.queries_prep import CLEAN_DROP, clean
from flowlens.plans.registry import register
from flowlens.sources.packets import read_table
from flowlens.sources.scores import EVENT_CLASS, scored_from_events


def scored(spark, sf):
    return scored_from_events(read_table(spark, sf, "events"))


def _raw(j):
    return (f"(CAST(((event_id * {2 * j + 3} + CAST(floor(value * 100) AS BIGINT)) % 101 + 1) AS DOUBLE)"
            f" + CASE WHEN y = {j} THEN 80.0 ELSE 0.0 END)")


_Y = "CASE event_type " + " ".join(f"WHEN '{e}' THEN {c}" for e, c in EVENT_CLASS.items()) + " END"
SCORED = f"""
sc0 AS (SELECT event_id, ts, value, {_Y} AS y FROM events),
sc1 AS (SELECT event_id, ts, y, {', '.join(f'{_raw(j)} AS r{j}' for j in range(5))} FROM sc0),
scored AS (
  SELECT event_id, ts, y, {', '.join(f'r{j} / ((((r0 + r1) + r2) + r3) + r4) AS p{j}' for j in range(5))},
         {', '.join(f'(r{j} - 100.0) / 50.0 AS s{j}' for j in range(5))}
  FROM sc1
)"""

# argmax helpers in SQL: first maximum wins
_P = [f"p{j}" for j in range(5)]
_S = [f"s{j}" for j in range(5)]


def _argmax(cols, offset=0):
    m = f"greatest({', '.join(cols)})"
    return "CASE " + " ".join(f"WHEN {c} = {m} THEN {i + offset}" for i, c in enumerate(cols)) + " END"


ARGMAX_P = _argmax(_P)
REST_P = _argmax(_P[1:], 1)
ARGMAX_S = _argmax(_S)
REST_S = _argmax(_S[1:], 1)
NAME = O.CLASS_CASE


def sql(*ctes, final):
    return O.with_ctes(*ctes, final=final)


@register("decide_threshold", sql(SCORED, final=f"""SELECT event_id, y, CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END AS pred
    FROM scored"""))
def q_decide_threshold(spark, sf):
    s = scored(spark, sf)
    return s.select("event_id", "y", D.decide_threshold("proba", 0.5).alias("pred"))


@register("decide_bias", sql(SCORED, final=f"""SELECT event_id, y,
    {_argmax(['s0 + 0.4'] + _S[1:])} AS pred FROM scored"""))
def q_decide_bias(spark, sf):
    s = scored(spark, sf)
    return s.select("event_id", "y", D.decide_bias("score", 0.4).alias("pred"))


@register("decide_argmax", sql(SCORED, final=f"SELECT event_id, y, {ARGMAX_P} AS pred FROM scored"))
def q_decide_argmax(spark, sf):
    s = scored(spark, sf)
    return s.select("event_id", "y", D.decide_argmax("proba").alias("pred"))


@register("prediction_table", sql(SCORED, f"pt AS (SELECT *, CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END AS pred FROM scored)",
                                  final=f"""SELECT event_id, pred, {NAME.format(c='pred')} AS prediction,
    round_even(CASE pred {' '.join(f'WHEN {j} THEN p{j}' for j in range(5))} END, 4) AS confidence,
    round_even(greatest(abs(s0), abs(s1), abs(s2), abs(s3), abs(s4)), 4) AS score_confidence,
    {', '.join(f'round_even(p{j}, 4) AS proba_{CLASS_NAMES[j]}' for j in range(5))} FROM pt"""),
          ["confidence", "score_confidence"] + [f"proba_{CLASS_NAMES[j]}" for j in range(5)])
def q_prediction_table(spark, sf):
    s = scored(spark, sf).withColumn("pred", D.decide_threshold("proba", 0.5))
    out = s.select("event_id", "pred", "proba", D.prediction_name("pred").alias("prediction"),
                   np_round(D.confidence_chosen("proba", "pred"), 4).alias("confidence"),
                   np_round(D.confidence_abs_max("score"), 4).alias("score_confidence"))
    return D.proba_columns(out, "proba").drop("proba")


def _counts_sql(pred_expr):
    return f"cnt AS (SELECT y, {pred_expr} AS pred, count(*) AS n FROM scored GROUP BY ALL)"


def _report_sql(src, keys=""):
    """SQL of report_from_counts over a (keys, y, pred, n) CTE ``src``."""
    k = f"{keys}, " if keys else ""
    on = " AND ".join([f"a.{x} = b.{x}" for x in keys.split(", ") if x] + ["a.c = b.c"]) if keys else "a.c = b.c"
    coal = ", ".join(f"coalesce(a.{x}, b.{x}) AS {x}" for x in keys.split(", ") if x)
    coal = (coal + ", ") if coal else ""
    gb = f"GROUP BY {keys}" if keys else ""
    return f"""
py AS (SELECT {k}y AS c, sum(n) AS sup, sum(CASE WHEN y = pred THEN n ELSE 0 END) AS tp FROM {src} GROUP BY {k}y),
pp AS (SELECT {k}pred AS c, sum(n) AS pp FROM {src} GROUP BY {k}pred),
pc AS (SELECT {coal}coalesce(a.c, b.c) AS c, coalesce(sup, 0) AS sup, coalesce(tp, 0) AS tp, coalesce(pp, 0) AS pp
       FROM py a FULL JOIN pp b ON {on}),
per AS (SELECT {k}c, CASE WHEN pp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pp END AS precision,
               CASE WHEN sup = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / sup END AS recall,
               CASE WHEN sup + pp = 0 THEN 0.0 ELSE CAST(tp * 2 AS DOUBLE) / (sup + pp) END AS f1, sup AS support, tp FROM pc),
tot AS (SELECT {k}sum(support) AS total, sum(tp) AS tp_all, avg(precision) AS m_p, avg(recall) AS m_r, avg(f1) AS m_f,
               sum(precision * support) AS w_p, sum(recall * support) AS w_r, sum(f1 * support) AS w_f FROM per {gb}),
rep AS (
  SELECT {k}{NAME.format(c='c')} AS cls, precision, recall, f1, CAST(support AS BIGINT) AS support FROM per
  UNION ALL SELECT {k}'accuracy', CAST(tp_all AS DOUBLE) / total, CAST(tp_all AS DOUBLE) / total, CAST(tp_all AS DOUBLE) / total, CAST(total AS BIGINT) FROM tot
  UNION ALL SELECT {k}'macro avg', m_p, m_r, m_f, CAST(total AS BIGINT) FROM tot
  UNION ALL SELECT {k}'weighted avg', w_p / total, w_r / total, w_f / total, CAST(total AS BIGINT) FROM tot
)"""


@register("class_report", sql(SCORED, _counts_sql(f"CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END"), _report_sql("cnt"),
                              final="SELECT * FROM rep"), ["precision", "recall", "f1"])
def q_class_report(spark, sf):
    s = scored(spark, sf).withColumn("pred", D.decide_threshold("proba", 0.5))
    return EV.class_report(s)


_CLS = " UNION ALL ".join(f"SELECT {a} AS actual, {b} AS predicted" for a in range(5) for b in range(5))
CONF = f"""
cg AS ({_CLS}),
cc AS (SELECT y AS actual, CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END AS predicted, count(*) AS count FROM scored GROUP BY ALL),
conf AS (SELECT cg.actual, cg.predicted, CAST(coalesce(cc.count, 0) AS BIGINT) AS count FROM cg LEFT JOIN cc USING (actual, predicted))"""


@register("confusion", sql(SCORED, CONF, final="SELECT * FROM conf"))
def q_confusion(spark, sf):
    s = scored(spark, sf).withColumn("pred", D.decide_threshold("proba", 0.5))
    return EV.confusion(s)


@register("confusion_norm", sql(SCORED, CONF, final="""SELECT actual, predicted, count,
    count / greatest(sum(count) OVER (PARTITION BY actual), 1) AS share FROM conf"""), ["share"])
def q_confusion_norm(spark, sf):
    s = scored(spark, sf).withColumn("pred", D.decide_threshold("proba", 0.5))
    return EV.confusion_norm(EV.confusion(s))


def _grid_sql(values, name):
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, CAST({v!r} AS DOUBLE))" for i, v in enumerate(values)) + f") AS g(i, v))"


_TG = EV.grid(EV.THRESHOLD_GRID)
_BG = EV.grid(EV.BIAS_GRID)
THR = f"""
{_grid_sql(_TG, 'tg')},
tcnt AS (SELECT tg.i, scored.y, CASE WHEN p0 >= tg.v THEN 0 ELSE {REST_P} END AS pred, count(*) AS n
         FROM scored, tg GROUP BY ALL)"""
BIAS = f"""
{_grid_sql(_BG, 'bg')},
tcnt AS (SELECT bg.i, scored.y, {_argmax(['s0 + bg.v'] + _S[1:])} AS pred, count(*) AS n FROM scored, bg GROUP BY ALL)"""


@register("tune_threshold_table", sql(SCORED, THR, _report_sql("tcnt", "i"),
                                      final="SELECT tg.v AS t, f1 AS macro_f1 FROM rep JOIN tg USING (i) WHERE cls = 'macro avg'"),
          ["t", "macro_f1"])
def q_tune_threshold_table(spark, sf):
    return EV.threshold_table(scored(spark, sf))


@register("tune_threshold", sql(SCORED, THR, _report_sql("tcnt", "i"),
                                final="""SELECT tg.v AS t, f1 AS macro_f1 FROM rep JOIN tg USING (i) WHERE cls = 'macro avg'
    ORDER BY macro_f1 DESC, t LIMIT 1"""), ["t", "macro_f1"])
def q_tune_threshold(spark, sf):
    return EV.tune_threshold(scored(spark, sf))


@register("tune_bias_table", sql(SCORED, BIAS, _report_sql("tcnt", "i"),
                                 final="SELECT bg.v AS b, f1 AS macro_f1 FROM rep JOIN bg USING (i) WHERE cls = 'macro avg'"),
          ["b", "macro_f1"])
def q_tune_bias_table(spark, sf):
    return EV.bias_table(scored(spark, sf))


@register("tune_bias", sql(SCORED, BIAS, _report_sql("tcnt", "i"),
                           final="""SELECT bg.v AS b, f1 AS macro_f1 FROM rep JOIN bg USING (i) WHERE cls = 'macro avg'
    ORDER BY macro_f1 DESC, b LIMIT 1"""), ["b", "macro_f1"])
def q_tune_bias(spark, sf):
    return EV.tune_bias(scored(spark, sf))


_UNP = " UNION ALL ".join(f"SELECT {j} AS c, p{j} AS s, y FROM scored" for j in range(5))
AUC = f"""
un AS ({_UNP}),
per AS (SELECT c, s, sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y <> c THEN 1 ELSE 0 END) AS neg
        FROM un GROUP BY c, s),
cum AS (SELECT *, sum(neg) OVER (PARTITION BY c ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM per),
auc AS (SELECT c, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                       THEN sum(pos * ((neg_le - neg) + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc
        FROM cum GROUP BY c)"""


@register("roc_auc_ovr", sql(SCORED, AUC, final=f"""SELECT {NAME.format(c='c')} AS cls, auc FROM auc
    UNION ALL SELECT 'macro', CASE WHEN count(*) FILTER (WHERE auc IS NULL) = 0 THEN avg(auc) END FROM auc"""), ["auc"])
def q_roc_auc(spark, sf):
    return EV.roc_auc_ovr(scored(spark, sf))


# ------------------------------------------------------------------ model comparison over rule variants
RULES = f"""
rules AS (
  SELECT 'threshold-0.5' AS model, y, CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END AS pred FROM scored
  UNION ALL SELECT 'argmax', y, {ARGMAX_P} FROM scored
  UNION ALL SELECT 'bias-0.4', y, {_argmax(['s0 + 0.4'] + _S[1:])} FROM scored
),
rcnt AS (SELECT model, y, pred, count(*) AS n FROM rules GROUP BY ALL)"""
METRICS = """
metrics AS (
  SELECT a.model, a.f1 AS accuracy, w.precision, w.recall, w.f1 FROM rep a JOIN rep w USING (model)
  WHERE a.cls = 'accuracy' AND w.cls = 'weighted avg'
)"""


def _metrics(spark, sf):
    s = scored(spark, sf)
    variants = [("threshold-0.5", D.decide_threshold("proba", 0.5)), ("argmax", D.decide_argmax("proba")),
                ("bias-0.4", D.decide_bias("score", 0.4))]
    rows = None
    for name, expr in variants:
        part = s.select(F.lit(name).alias("model"), "y", expr.alias("pred"))
        rows = part if rows is None else rows.unionByName(part)
    counts = rows.groupBy("model", "y", "pred").agg(F.count(F.lit(1)).alias("n"))
    rep = EV.report_from_counts(counts, ["model"])
    a = rep.where(F.col("cls") == "accuracy").select("model", F.col("f1").alias("accuracy"))
    w = rep.where(F.col("cls") == "weighted avg").select("model", "precision", "recall", "f1")
    return a.join(w, "model")


@register("comparison", sql(SCORED, RULES, _report_sql("rcnt", "model"), METRICS,
                            final="SELECT * FROM metrics ORDER BY f1 DESC, model"), ["accuracy", "precision", "recall", "f1"])
def q_comparison(spark, sf):
    return EV.comparison(_metrics(spark, sf))


@register("best_model", sql(SCORED, RULES, _report_sql("rcnt", "model"), METRICS,
                            final="SELECT * FROM metrics ORDER BY f1 DESC, model LIMIT 1"), ["accuracy", "precision", "recall", "f1"])
def q_best_model(spark, sf):
    return EV.best_model(_metrics(spark, sf))


# ------------------------------------------------------------------ replay
PRED = f"""
pr AS (SELECT event_id, ts, CASE WHEN p0 >= 0.5 THEN 0 ELSE {REST_P} END AS pred, p0, p1, p2, p3, p4 FROM scored),
pn AS (SELECT event_id, ts, {NAME.format(c='pred')} AS prediction,
              CASE pred {' '.join(f'WHEN {j} THEN p{j}' for j in range(5))} END AS confidence FROM pr)"""
_CNT = ", ".join(f"sum(CASE WHEN prediction = '{c}' THEN 1 ELSE 0 END) OVER w AS n_{c}" for _, c in sorted(CLASS_NAMES.items()))
COUNTERS = f"""
ctr AS (SELECT *, count(*) OVER w AS win_idx, sum(CASE WHEN prediction <> 'Normal' THEN 1 ELSE 0 END) OVER w AS total_threats,
               {_CNT}
        FROM pn WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def predictions(spark, sf):
    s = scored(spark, sf).withColumn("pred", D.decide_threshold("proba", 0.5))
    return s.select("event_id", "ts", D.prediction_name("pred").alias("prediction"),
                    D.confidence_chosen("proba", "pred").alias("confidence"))


def counters(spark, sf, total_col=None):
    return R.running_counters(predictions(spark, sf).withColumn("_t", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("double")),
                              order_by=("_t", "event_id"), total_col=total_col).drop("_t")


@register("threats", sql(SCORED, PRED, final="SELECT * FROM pn WHERE prediction <> 'Normal'"), ["confidence"])
def q_threats(spark, sf):
    return R.threats(predictions(spark, sf))


@register("prediction_counts", sql(SCORED, PRED, final="SELECT prediction, count(*) AS count FROM pn GROUP BY prediction"))
def q_prediction_counts(spark, sf):
    return R.prediction_counts(predictions(spark, sf))


@register("running_counters", sql(SCORED, PRED, COUNTERS, final="SELECT * FROM ctr"), ["confidence"])
def q_running_counters(spark, sf):
    return counters(spark, sf)


@register("timeline_120", sql(SCORED, PRED, COUNTERS, final="""SELECT win_idx, 'W' || CAST(win_idx AS VARCHAR) AS label,
    CASE WHEN prediction <> 'Normal' THEN 0.0 ELSE CAST(printf('%.3f', confidence) AS DOUBLE) END AS normal,
    CASE WHEN prediction <> 'Normal' THEN CAST(printf('%.3f', confidence) AS DOUBLE) ELSE 0.0 END AS threat
    FROM ctr WHERE win_idx > (SELECT max(win_idx) FROM ctr) - 120"""), ["normal", "threat"])
def q_timeline(spark, sf):
    return R.timeline_tail(counters(spark, sf, "total_windows"))


@register("metrics_snapshots", sql(SCORED, PRED, COUNTERS, final=f"""SELECT win_idx, total_threats,
    {', '.join(f'n_{c}' for _, c in sorted(CLASS_NAMES.items()))},
    CAST(least(95, floor(5.0 + (win_idx / (SELECT max(win_idx) FROM ctr)) * 90.0)) AS INTEGER) AS progress
    FROM ctr WHERE win_idx % 5 = 0 OR win_idx = (SELECT max(win_idx) FROM ctr)"""))
def q_snapshots(spark, sf):
    return R.metrics_snapshots(counters(spark, sf, "total_windows"))


@register("replay_summary", sql(SCORED, PRED, O.PACKETS, CLEAN_DROP, final=f"""SELECT count(*) AS windows,
    (SELECT count(*) FROM clean) AS total_packets,
    CAST(sum(CASE WHEN prediction <> 'Normal' THEN 1 ELSE 0 END) AS BIGINT) AS total_threats,
    {', '.join(f"CAST(sum(CASE WHEN prediction = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{c}" for _, c in sorted(CLASS_NAMES.items()))}
    FROM pn"""))
def q_replay_summary(spark, sf):
    """E19 with the packets of the capture as the dashboard cleans it."""
    return R.replay_summary(predictions(spark, sf), packets=clean(spark, sf, "drop"))
