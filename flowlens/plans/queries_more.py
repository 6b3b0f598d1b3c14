"""Registered queries: dashboard windows/scoring, model selection, importances, CSV and
feature-table round trips, class filter, global sort, DT/ensemble training, streaming scores."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES
from flowlens.operators import ml
from flowlens.operators.clean import clean_packets
from flowlens.operators.packet_features import packet_features
from flowlens.operators.timeline import global_sort
from flowlens.operators.windows import window_features
from flowlens.plans import oracle as O
from flowlens.plans.queries_eda import TRAIN, train_windows
from flowlens.plans.queries_eval import RULES, METRICS, SCORED, _metrics, _report_sql
from flowlens.plans.queries_prep import BASE, CLEAN_DROP, TIMELINE, clean, timeline
from flowlens.plans.queries_stream import _scratch
from flowlens.plans.registry import register
from flowlens.session import materialize, shared_path
from flowlens.sources.packets import packets_from_events, read_packets_csv

DASH_DOUBLES = [d for d in O.WINDOW_DOUBLES if d != "dominant_ratio"]


def sql(*ctes, final):
    return O.with_ctes(*ctes, final=final)


def dashboard_windows(spark, sf, method="chunks"):
    # written, as the training packets are: gaps, ranks and windows read them eight times
    packets = materialize(packet_features(materialize(clean(spark, sf, "drop"))))
    return window_features(packets, method=method, dashboard=True)


CLEAN_DROP_FEAT = [O.PACKETS, CLEAN_DROP]


@register("dashboard_windows", sql(*CLEAN_DROP_FEAT, O.feat_cte(), O.windows_sql("feat"), O.dashboard_sql(),
                                   final="SELECT * FROM dash"), DASH_DOUBLES)
def q_dashboard_windows(spark, sf):
    """T4b/G21 with the dashboard's cleaning (invalid length -> row dropped)."""
    return dashboard_windows(spark, sf)


@register("dashboard_windows_explode", sql(*CLEAN_DROP_FEAT, O.feat_cte(), O.windows_sql("feat"), O.dashboard_sql(),
                                           final="SELECT * FROM dash"), DASH_DOUBLES)
def q_dashboard_windows_explode(spark, sf):
    return dashboard_windows(spark, sf, "explode")


@register("select_model", sql(SCORED, RULES, _report_sql("rcnt", "model"), METRICS, """
mb AS (SELECT *, row_number() OVER (ORDER BY f1 DESC, model) = 1 AS is_best FROM metrics)""",
                              final="""SELECT model, accuracy, precision, recall, f1,
    row_number() OVER (ORDER BY CASE WHEN lower(model) LIKE '%ensemble%' OR lower(model) LIKE '%voting%' THEN 0
                                     WHEN is_best THEN 1 ELSE 2 END, model) AS pick FROM mb"""),
          ["accuracy", "precision", "recall", "f1"])
def q_select_model(spark, sf):
    return ml.select_model_table(_metrics(spark, sf))


@register("filter_class", sql(*TRAIN, final="SELECT * FROM windows WHERE Label = 3"), O.WINDOW_DOUBLES)
def q_filter_class(spark, sf):
    return train_windows(spark, sf).where(F.col("Label") == 3)


@register("global_sort", sql(*TIMELINE, final="SELECT no, capture_ord, global_time FROM timeline ORDER BY global_time, capture_ord, no"),
          ["global_time"])
def q_global_sort(spark, sf):
    return global_sort(timeline(spark, sf)).select("no", "capture_ord", "global_time")


CSV_COLS = {"no": "No.", "time": "Time", "source": "Source", "destination": "Destination", "protocol": "Protocol",
            "length": "Length", "info": "Info"}


@register("scan_packets_csv", sql(*BASE, final="SELECT no, time, source, destination, protocol, length, info FROM clean"),
          ["time"])
def q_scan_csv(spark, sf):
    """S1 on CSV: the adapted packets written as a capture-tool CSV export, scanned with the
    fixed schema, then cleaned."""
    path = _scratch(spark, "packets-csv")
    src = packets_from_events(spark, sf).select(*[F.col(k).cast("string").alias(v) for k, v in CSV_COLS.items()])
    src.write.option("header", True).csv(path)
    return clean_packets(read_packets_csv(spark, path))


@register("features_roundtrip", sql(*TRAIN, final="SELECT * FROM windows"), O.WINDOW_DOUBLES)
def q_features_roundtrip(spark, sf):
    """S4 + S3: write the window feature table (Parquet) and scan it back."""
    path = _scratch(spark, "features")
    train_windows(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def _fit(spark, sf, names):
    return ml.train_all(train_windows(spark, sf), names, ensemble=True)


@register("train_dt_eval")
def q_train_dt(spark, sf):
    """M6 + M14 + M16-M19 + M24: decision tree, tuned threshold, evaluation row."""
    return ml.metrics_table(spark, _fit(spark, sf, ["Decision Tree"])["results"])


@register("train_ensemble_eval")
def q_train_ensemble(spark, sf):
    """M5 + M7 + M10: random forest, logistic regression and their soft vote."""
    return ml.metrics_table(spark, _fit(spark, sf, ["Random Forest", "Logistic Regression"])["results"])


@register("feature_importance")
def q_importance(spark, sf):
    """M20 + M21: importances of the random forest (top 15)."""
    tr = _fit(spark, sf, ["Random Forest"])
    rows = [(name, f, float(v)) for name, r in tr["results"].items() for f, v in (r["fi"] or [])]
    imp = spark.createDataFrame(rows, "model string, feature string, importance double")
    return ml.importance_top(imp, 15)


def _rf_bundle(spark, sf):
    tr = ml.train_all(train_windows(spark, sf), ["Random Forest"], ensemble=False)
    path = shared_path(spark, f"bundle-rf-dash-{uuid.uuid4().hex}")
    ml.save_bundle(path, tr, "Random Forest")
    return ml.load_bundle(spark, path)


@register("dashboard_predict")
def q_dashboard_predict(spark, sf):
    """Dashboard windows scored with argmax and max-probability confidence."""
    return ml.score_windows(_rf_bundle(spark, sf), dashboard_windows(spark, sf), "Random Forest", rule="argmax")


@register("stream_scores")
def q_stream_scores(spark, sf):
    """Stateless scoring of the streaming window table (X1 output read as a stream)."""
    from flowlens.plans.queries_stream import q_stream_windows
    from flowlens.streaming import streams as X

    bundle = _rf_bundle(spark, sf)
    wins = q_stream_windows(spark, sf)
    base = _scratch(spark, "x2-in")
    wins.write.parquet(base)
    stream = spark.readStream.schema(wins.schema).option("maxFilesPerTrigger", 1).parquet(base)
    out, ck = _scratch(spark, "x2-out"), _scratch(spark, "x2-ck")
    X.run_to_table(X.stream_scores(stream, bundle, "Random Forest"), out, ck)
    return spark.read.parquet(out)
