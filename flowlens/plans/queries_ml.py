"""Registered queries: model preparation (D oracles) and training/scoring (rows-only)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.operators import ml
from flowlens.plans import oracle as O
from flowlens.plans.queries_eda import TRAIN, train_windows
from flowlens.plans.registry import register
from flowlens.session import shared_path

SPLIT = """
spl AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY Label ORDER BY window_idx) - 1
                      < floor(count(*) OVER (PARTITION BY Label) * CAST(0.70 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
  FROM windows
)"""


def sql(*ctes, final):
    return O.with_ctes(*ctes, final=final)


@register("temporal_split", sql(*TRAIN, SPLIT, final="SELECT window_idx, Label, split FROM spl"))
def q_split(spark, sf):
    return ml.temporal_split(train_windows(spark, sf)).select("window_idx", "Label", "split")


@register("class_weights", sql(*TRAIN, SPLIT, """
tr AS (SELECT * FROM spl WHERE split = 'train'),
cw AS (SELECT Label, count(*) AS nc FROM tr GROUP BY Label)""", final="""SELECT tr.window_idx, tr.Label,
    (SELECT count(*) FROM tr) / ((SELECT count(*) FROM cw) * cw.nc) AS weight FROM tr JOIN cw USING (Label)"""), ["weight"])
def q_weights(spark, sf):
    data, _ = ml.prepare(train_windows(spark, sf))
    return data.where(F.col("split") == "train").select("window_idx", "Label", "weight")


_STD = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg(CAST(coalesce(CAST({c} AS FLOAT), 0) AS DOUBLE)) AS mean,
        CASE WHEN stddev_pop(CAST(coalesce(CAST({c} AS FLOAT), 0) AS DOUBLE)) = 0 THEN 1.0
             ELSE stddev_pop(CAST(coalesce(CAST({c} AS FLOAT), 0) AS DOUBLE)) END AS std
        FROM spl WHERE split = 'train'""" for c in FEATURE_COLS)


@register("standardize", sql(*TRAIN, SPLIT, final=_STD), ["mean", "std"])
def q_standardize(spark, sf):
    tr = ml.temporal_split(train_windows(spark, sf)).where(F.col("split") == "train")
    st = ml.fit_scaler(tr)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
            for i, c in enumerate(FEATURE_COLS)]
    return st.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@register("feature_vector", sql(*TRAIN, final="SELECT window_idx, Label, ["
                                + ", ".join(f"CAST(coalesce(CAST({c} AS FLOAT), 0) AS FLOAT)" for c in FEATURE_COLS)
                                + "] AS features FROM windows"))
def q_feature_vector(spark, sf):
    from pyspark.ml.functions import vector_to_array

    v = ml.assemble(ml.feature_columns(train_windows(spark, sf)))
    return v.select("window_idx", "Label", vector_to_array("features", "float32").alias("features"))


@register("train_rf_eval")
def q_train_rf(spark, sf):
    tr = ml.train_all(train_windows(spark, sf), ["Random Forest"], ensemble=False)
    return ml.metrics_table(spark, tr["results"])


@register("train_svm_eval")
def q_train_svm(spark, sf):
    """M8: the linear SVM with its tuned bias."""
    tr = ml.train_all(train_windows(spark, sf), ["SVM (Linear)"], ensemble=False)
    return ml.metrics_table(spark, tr["results"])


@register("predict_svm")
def q_predict_svm(spark, sf):
    """M25 with a model without probabilities: fit, save and reload the bundle, score the labelled windows by the
    stored bias; decision values beside the prediction."""
    windows = train_windows(spark, sf)
    tr = ml.train_all(windows, ["SVM (Linear)"], ensemble=False)
    path = shared_path(spark, f"bundle-svm-{uuid.uuid4().hex}")
    ml.save_bundle(path, tr, "SVM (Linear)")
    return ml.score_windows(ml.load_bundle(spark, path), windows)


VOTERS = ["Random Forest", "Logistic Regression"]
VOTE = "Ensemble (Soft Voting)"


def checked(scored, threshold: float):
    """What any scoring has to hold, from the rounded output columns of ``score_windows``: probabilities that sum to 1, the
    stored threshold applied anew gives the prediction, the confidence is the predicted class's probability."""
    eps = F.lit(1e-4)  # outputs have 4 decimals
    names = [n for _, n in sorted(CLASS_NAMES.items())]
    p = {n: F.col(f"proba_{n}") for n in names}
    own = F.coalesce(*[F.when(F.col("prediction") == n, p[n]) for n in names])
    normal = F.col("prediction") == names[0]
    rule = F.when(normal, p[names[0]] >= threshold - eps).otherwise(
        (p[names[0]] < threshold + eps) & (own >= F.greatest(*[p[n] for n in names[1:]]) - eps))
    return scored.select("window_idx", "Label", "pkt_count", (F.abs(sum(p.values()) - 1) <= 5 * eps).alias("sums_to_one"),
                         rule.alias("rule_holds"), (F.abs(F.col("confidence") - own) <= eps).alias("confidence_holds"))


def checked_sql(names):
    return sql(*TRAIN, final=f"""SELECT model, window_idx, Label, pkt_count, TRUE AS sums_to_one, TRUE AS rule_holds,
    TRUE AS confidence_holds FROM windows, (VALUES {', '.join(f"('{m}')" for m in names)}) AS m(model)""")


def checked_scores(spark, sf, fit, score):
    """Models fitted on the training windows, saved as a bundle, loaded, and every labelled window scored by each."""
    windows = train_windows(spark, sf)
    path = shared_path(spark, f"bundle-checked-{uuid.uuid4().hex}")
    ml.save_bundle(path, ml.train_all(windows, fit), score[-1])
    bundle = ml.load_bundle(spark, path)
    out = None
    for name in score:
        one = checked(ml.score_windows(bundle, windows, name), bundle["meta"]["models"][name]["threshold"])
        one = one.select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("predict_ensemble", checked_sql([*VOTERS, VOTE]))
def q_predict_ensemble(spark, sf):
    """Forest, logistic regression and their soft vote; SQL holds the windows, the stored rules are
    applied anew to the probabilities."""
    return checked_scores(spark, sf, VOTERS, [*VOTERS, VOTE])


@register("predict_gbt", checked_sql(["Gradient Boosting"]))
def q_predict_gbt(spark, sf):
    """Boosting, checked like the ensemble."""
    return checked_scores(spark, sf, ["Gradient Boosting"], ["Gradient Boosting"])


@register("predict_rf")
def q_predict_rf(spark, sf):
    """Fit RF on the training windows, save and reload the bundle, score the windows of
    the unlabelled capture path (clean -> features -> windows)."""
    from flowlens.plans.queries_prep import clean
    from flowlens.operators.packet_features import packet_features
    from flowlens.operators.windows import window_features

    tr = ml.train_all(train_windows(spark, sf), ["Random Forest"], ensemble=False)
    path = shared_path(spark, f"bundle-rf-{uuid.uuid4().hex}")
    ml.save_bundle(path, tr, "Random Forest")
    bundle = ml.load_bundle(spark, path)
    w = window_features(packet_features(clean(spark, sf)))
    return ml.score_windows(bundle, w, "Random Forest")
