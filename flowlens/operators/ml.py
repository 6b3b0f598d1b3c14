"""Model preparation, training, scoring and bundles.

Spark ML estimators do the fitting (distributed). Scores become plain array columns
so the decision rules and evaluation tables in ``decide``/``evaluate`` apply as is.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, FEATURE_COLS, RANDOM_SEED, STEP_SIZE, TRAIN_FRACTION, WINDOW_SIZE
from flowlens.operators import decide as D
from flowlens.operators import evaluate as EV
from flowlens.operators.boosting import BoostedTrees, BoostedTreesModel
from flowlens.operators.forest import ForestClassifier, ForestModel
from flowlens.functions.packet import np_round
from flowlens.operators.rank import packet_rank
from flowlens.operators.svm import LinearOvrModel, LinearOvrSvm
from flowlens.session import materialize

LABEL = "Label"
#: models of this library (the others are Spark's)
OWN_MODELS = (LinearOvrModel, BoostedTreesModel, ForestModel)


# ---------------------------------------------------------------- preparation
def feature_columns(df: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M1 (columns): the model inputs in fixed order, null -> 0, as float32."""
    return df.select("*", *[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).alias(f"_f_{c}") for c in cols])


def assemble(df: DataFrame, cols: Sequence[str] = FEATURE_COLS, out: str = "features", prefix: str = "_f_") -> DataFrame:
    """M1: dense feature vector (VectorAssembler) from the prepared columns."""
    names = [f"{prefix}{c}" for c in cols]
    va = VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep")
    return va.transform(df).drop(*names)


def temporal_split(windows: DataFrame, frac: float = TRAIN_FRACTION, label: str = LABEL, order: str = "window_idx") -> DataFrame:
    """M2: per class, the first floor(n*frac) windows in window order are train, the rest test
    (double arithmetic, as the reference). Keyed two-level rank: no single-partition window."""
    r = packet_rank(windows, order_by=(order, order), rank_col="_cr", keys=[label], total_col="_cn")
    cut = F.floor(F.col("_cn").cast("double") * F.lit(float(frac)))
    return r.withColumn("split", F.when(F.col("_cr") < cut, F.lit("train")).otherwise(F.lit("test"))).drop("_cr", "_cn")


def class_weights(df: DataFrame, label: str = LABEL, out: str = "weight", train: DataFrame | None = None) -> DataFrame:
    """M3: balanced sample weights n / (k * n_c), counted over ``train`` (``df`` itself by
    default); a class that is not in it has weight null. The per-class counts have one row
    per class (bounded by the class list): broadcast."""
    counts = (df if train is None else train).groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")


def fit_scaler(train: DataFrame, cols: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M4 fit: per-feature mean and population std on the train rows (one-row table).
    A zero std is replaced by 1 (nothing is divided by zero)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    stats = train.agg(*aggs)
    return stats.select(*[F.col(f"m{i}") for i in range(len(cols))],
                        *[F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias(f"s{i}")
                          for i in range(len(cols))])


def apply_scaler(df: DataFrame, stats: DataFrame, cols: Sequence[str] = FEATURE_COLS, prefix: str = "_z_") -> DataFrame:
    """M4 transform: (x - mean) / std with the train statistics (one row, broadcast)."""
    j = df.crossJoin(F.broadcast(stats))
    scaled = [((F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).cast("double") - F.col(f"m{i}")) / F.col(f"s{i}"))
              .alias(f"{prefix}{c}") for i, c in enumerate(cols)]
    return j.select(*df.columns, *scaled)


# ---------------------------------------------------------------- models
def model_defs(n_train: int, boost_rounds: int = 100) -> dict[str, tuple[object, bool, str]]:
    """name -> (estimator, needs scaled input, output kind 'proba' | 'score')."""
    reg = 1.0 / max(n_train, 1)  # sklearn C=1 with L2 on the sample-weighted sum of losses
    return {
        # node ids kept by row: else every pass ships the trees grown so far in its tasks; written every other pass: until then
        # a pass ships the splits of all passes since (same trees either way)
        "Random Forest": (ForestClassifier(numTrees=100, maxDepth=20, seed=RANDOM_SEED, weightCol="weight", labelCol=LABEL,
                                           featuresCol="features", cacheNodeIds=True, checkpointInterval=2), False, "proba"),
        "Decision Tree": (DecisionTreeClassifier(maxDepth=15, seed=RANDOM_SEED, weightCol="weight", labelCol=LABEL,
                                                 featuresCol="features"), False, "proba"),
        "Logistic Regression": (LogisticRegression(maxIter=500, family="multinomial", regParam=reg, standardization=False,
                                                   weightCol="weight", labelCol=LABEL, featuresCol="scaled"), True, "proba"),
        "SVM (Linear)": (LinearOvrSvm(features="scaled", label=LABEL, n_classes=len(CLASS_NAMES)), True, "score"),
        "Gradient Boosting": (BoostedTrees(features="features", label=LABEL, n_classes=len(CLASS_NAMES), rounds=boost_rounds), False, "proba"),
    }


def prepare(windows: DataFrame, stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split, weight, scale (scaler fitted on train) and assemble both vectors."""
    sp = temporal_split(windows)
    train = sp.where(F.col("split") == "train")
    sp = class_weights(sp, train=train)
    if stats is None:
        stats = fit_scaler(train)
    z = apply_scaler(sp, stats)
    z = assemble(feature_columns(z), out="features")
    z = assemble(z, out="scaled", prefix="_z_")
    return z, stats


def class_scores(model, kind: str, df: DataFrame, n_classes: int = len(CLASS_NAMES)) -> DataFrame:
    """Model output as an array column ``proba`` (probabilities) or ``score`` (decision values) over the full class list."""
    out = model.transform(df)
    if kind == "score":
        return out.withColumn("score", _pad(_array(model, "rawPrediction"), n_classes))
    return out.withColumn("proba", _pad(_array(model, "probability"), n_classes))


def _array(model, col: str) -> Column:
    """Output column of a model as an array (the library's own models give arrays, Spark's give vectors)."""
    return F.col(col) if isinstance(model, OWN_MODELS) else vector_to_array(col)


def _pad(arr: Column, n: int) -> Column:
    return F.concat(arr, F.array_repeat(F.lit(0.0), F.greatest(F.lit(n) - F.size(arr), F.lit(0))))


def ensemble_proba(parts: Sequence[Column]) -> Column:
    """Soft vote = element-wise mean of member probability arrays."""
    acc = parts[0]
    for p in parts[1:]:
        acc = F.zip_with(acc, p, lambda a, b: a + b)
    k = float(len(parts))
    return F.transform(acc, lambda x: x / k)


def ensemble_scores(voters: Sequence[tuple], df: DataFrame) -> DataFrame:
    """The soft vote of fitted (model, kind) members as column ``proba``."""
    cols = []
    for i, (model, kind) in enumerate(voters):
        df = class_scores(model, kind, df).withColumnRenamed("proba", f"_p{i}").drop("rawPrediction", "probability", "prediction")
        cols.append(F.col(f"_p{i}"))
    return df.withColumn("proba", ensemble_proba(cols))


def evaluate_scored(scored: DataFrame, kind: str, tune: DataFrame | None = None) -> dict:
    """Tune the decision rule on ``tune`` (default: the scored test rows, as the reference)
    and collect the small evaluation tables of ``scored``. Returns plain Python values
    (bounded: per class / per grid value)."""
    tune = scored if tune is None else tune
    if kind == "score":
        best = EV.tune_bias(tune, "Label", "score").first()
        rule = {"bias": float(best["b"]), "threshold": None}
        pred = D.decide_bias("score", rule["bias"])
        auc_col = "score"
    else:
        best = EV.tune_threshold(tune, "Label", "proba").first()
        rule = {"threshold": float(best["t"]), "bias": None}
        pred = D.decide_threshold("proba", rule["threshold"])
        auc_col = "proba"
    p = scored.withColumn("pred", pred)
    rep = {r["cls"]: r.asDict() for r in EV.class_report(p, "Label", "pred").collect()}
    auc = {r["cls"]: r["auc"] for r in EV.roc_auc_ovr(scored, "Label", auc_col).collect()}
    cm = [(r["actual"], r["predicted"], r["count"]) for r in EV.confusion(p, "Label", "pred").collect()]
    return {"rule": rule, "macro_f1": float(best["macro_f1"]), "report": rep, "roc_auc": auc.get("macro"), "confusion": cm}


def feature_importance(model, name: str, cols: Sequence[str] = FEATURE_COLS) -> list[tuple[str, float]]:
    """Tree importances, or the mean absolute coefficient over classes, for one-vs-rest
    models the mean over their members; a model without either gets 1/n for every feature."""
    if isinstance(model, tuple):
        members = [dict(feature_importance(m, name, cols)) for m in model[0].models]
        return [(c, sum(m[c] for m in members) / len(members)) for c in cols]
    if isinstance(model, OWN_MODELS):
        return list(zip(cols, model.importances()))
    if isinstance(model, LinearSVCModel):
        return list(zip(cols, [abs(float(x)) for x in model.coefficients.toArray()]))
    if hasattr(model, "featureImportances"):
        v = model.featureImportances.toArray()
        return list(zip(cols, [float(x) for x in v]))
    if isinstance(model, LogisticRegressionModel):
        m = model.coefficientMatrix.toArray()
        return list(zip(cols, [float(x) for x in abs(m).mean(axis=0)]))
    return [(c, 1.0 / len(cols)) for c in cols]


def importance_top(imp: DataFrame, k: int = 15) -> DataFrame:
    """Top-k features per model (ties by name)."""
    from pyspark.sql import Window

    w = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return imp.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _written(scored: DataFrame, col: str) -> DataFrame:
    """What the evaluation reads of scored rows, written once: its many jobs would score anew and ship the model each time."""
    return materialize(scored.select(LABEL, col))


#: rows of a partition that is worth a core of its own in a fit, and most rows of one
FIT_ROWS, MOST_ROWS = 2_000, 50_000


def fit_partitions(rows: int, have: int, cores: int) -> int:
    """Partitions of the rows that models are fitted on: a pass of a forest makes, sends and merges the statistics of all open
    nodes once per partition however few rows it has, so there are no more than cores unless MOST_ROWS asks for them.
    Small tables stay as they lie (a forest's draws go by partition)."""
    if rows <= FIT_ROWS:
        return have
    return max(1, min(have, max(-(-rows // MOST_ROWS), min(cores, -(-rows // FIT_ROWS)))))


def _fit_rows(data: DataFrame) -> DataFrame:
    """Prepared rows written once (the passes of a fit would ship the plan of the windows with every task), in few partitions."""
    cached = data.persist()
    data = materialize(cached)
    cached.unpersist()
    sc = data.sparkSession.sparkContext
    return data.coalesce(fit_partitions(data.count(), data.rdd.getNumPartitions(), sc.defaultParallelism))


def train_all(windows: DataFrame, names: Sequence[str] | None = None, ensemble: bool = True,
              tune_on: str = "test", boost_rounds: int = 100) -> dict:
    """M5-M10 + M14/M15 + M16-M20 + M24: fit every model on the train split, tune its rule
    (on the test split as the reference does, or ``tune_on="train"``), evaluate on test.
    Returns {models, stats, results}."""
    data, stats = prepare(windows)
    data = _fit_rows(data).persist()
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")
    n_train = train.count()
    defs = model_defs(n_train, boost_rounds)
    names = list(names or defs)
    models, results = {}, {}
    for name in names:
        est, _, kind = defs[name]
        t0 = time.time()
        model = est.fit(train)
        secs = time.time() - t0  # M24: wall-clock of the fit
        col = "score" if kind == "score" else "proba"
        scored = _written(class_scores(model, kind, test), col)
        tune = _written(class_scores(model, kind, train), col) if tune_on == "train" else None
        ev = evaluate_scored(scored, col, tune)
        models[name] = (model, kind)
        results[name] = {**ev, "train_time": round(secs, 4), "fi": feature_importance(model, name)}
    if ensemble:
        members = [n for n in ("Random Forest", "Logistic Regression", "Gradient Boosting") if n in models]
        if len(members) >= 2:
            voters = [models[m] for m in members]
            tune = _written(ensemble_scores(voters, train), "proba") if tune_on == "train" else None
            ev = evaluate_scored(_written(ensemble_scores(voters, test), "proba"), "proba", tune)
            # the members are fitted once and shared: the vote's fit is the sum of theirs
            secs = sum(results[m]["train_time"] for m in members)
            fi = results["Random Forest"]["fi"] if "Random Forest" in results else []
            results["Ensemble (Soft Voting)"] = {**ev, "train_time": round(secs, 4), "fi": fi,
                                                 "members": members}
    data.unpersist()
    return {"models": models, "stats": stats, "results": results}


def metrics_table(spark, results: dict) -> DataFrame:
    """One row per model (accuracy, weighted precision/recall/F1, macro ROC-AUC, fit time)."""
    rows = []
    for name, r in results.items():
        w = r["report"]["weighted avg"]
        rows.append((name, float(r["report"]["accuracy"]["f1"]), float(w["precision"]), float(w["recall"]), float(w["f1"]),
                     None if r["roc_auc"] is None else float(r["roc_auc"]), float(r["train_time"])))
    return spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, f1 double, "
                                       "roc_auc double, train_time double")


# ---------------------------------------------------------------- bundle
def save_bundle(path: str, trained: dict, best: str, window_size: int = WINDOW_SIZE, step_size: int = STEP_SIZE) -> None:
    """Each model with its own Spark ML writer, scaler statistics as Parquet, metadata as JSON."""
    spark = trained["stats"].sparkSession
    meta = {"feature_cols": FEATURE_COLS, "class_names": {str(k): v for k, v in CLASS_NAMES.items()},
            "best_model": best, "window_size": window_size, "step_size": step_size, "models": {}}
    for i, (name, (model, kind)) in enumerate(trained["models"].items()):
        sub = f"model_{i}"
        if isinstance(model, OWN_MODELS):
            model.save(os.path.join(path, sub))
        else:
            model.write().overwrite().save(os.path.join(path, sub))
        r = trained["results"][name]
        meta["models"][name] = {"dir": sub, "kind": kind, "class": type(model).__name__,
                                "needs_scaling": name in ("Logistic Regression", "SVM (Linear)"),
                                "threshold": r["rule"]["threshold"], "bias": r["rule"]["bias"]}
    ens = trained["results"].get("Ensemble (Soft Voting)")
    if ens:
        meta["models"]["Ensemble (Soft Voting)"] = {"kind": "ensemble", "members": ens["members"],
                                                    "threshold": ens["rule"]["threshold"], "bias": None,
                                                    "needs_scaling": True}
    trained["stats"].write.mode("overwrite").parquet(os.path.join(path, "scaler"))
    meta_df = spark.createDataFrame([(json.dumps(meta),)], "meta string")
    meta_df.coalesce(1).write.mode("overwrite").text(os.path.join(path, "meta"))


_LOADERS = {"RandomForestClassificationModel": RandomForestClassificationModel,
            "DecisionTreeClassificationModel": DecisionTreeClassificationModel,
            "LogisticRegressionModel": LogisticRegressionModel, "PipelineModel": PipelineModel,
            "LinearOvrModel": LinearOvrModel, "BoostedTreesModel": BoostedTreesModel, "ForestModel": ForestModel}


def load_bundle(spark, path: str) -> dict:
    """Metadata, scaler statistics and every model (loaded by its recorded class)."""
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    stats = spark.read.parquet(os.path.join(path, "scaler"))
    models = {}
    for name, m in meta["models"].items():
        if m["kind"] != "ensemble":
            model = _LOADERS[m["class"]].load(os.path.join(path, m["dir"]))
            models[name] = (model, m["kind"])
    return {"meta": meta, "stats": stats, "models": models}


def select_model_table(metrics: DataFrame) -> DataFrame:
    """S7 over a metrics table: ensemble/voting models first, then the best model (highest
    F1, name breaks ties), then the rest by name; ``pick`` = 1 is the model used."""
    from pyspark.sql import Window

    best = Window.orderBy(F.desc("f1"), "model")
    low = F.lower(F.col("model"))
    ranked = metrics.withColumn("_best", F.row_number().over(best) == 1)
    cls = F.when(low.contains("ensemble") | low.contains("voting"), 0).when(F.col("_best"), 1).otherwise(2)
    # one row per model: a window over this small table is fine
    return ranked.withColumn("pick", F.row_number().over(Window.orderBy(cls, "model"))).drop("_best")


def select_model(names: Sequence[str], best: str | None) -> list[str]:
    """ensemble/voting models first, then the best model, then the rest, each by name as in ``select_model_table``."""
    def key(n):
        low = n.lower()
        return (0 if ("ensemble" in low or "voting" in low) else 1 if n == best else 2, n)

    return sorted(names, key=key)


# ---------------------------------------------------------------- scoring
def score_windows(bundle: dict, windows: DataFrame, model_name: str | None = None, rule: str = "tuned") -> DataFrame:
    """Windows -> scale as the model was trained -> probabilities/scores -> decision rule
    with the stored threshold/bias (``rule="argmax"`` for the dashboard path, M29) -> T5."""
    meta = bundle["meta"]
    name = model_name or select_model(list(meta["models"]), meta["best_model"])[0]
    m = meta["models"][name]
    z = apply_scaler(windows, bundle["stats"])
    z = assemble(feature_columns(z), out="features")
    z = assemble(z, out="scaled", prefix="_z_")
    if m["kind"] == "ensemble":
        scored = ensemble_scores([bundle["models"][member] for member in m["members"]], z)
        kind = "proba"
    else:
        model, kind = bundle["models"][name]
        scored = class_scores(model, kind, z)
        kind = "score" if kind == "score" else "proba"
    if kind == "score":
        pred = D.argmax("score") if rule == "argmax" else D.decide_bias("score", m["bias"] or 0.0)
        # the dashboard path has no confidence for a model without probabilities
        conf = F.lit(float("nan")) if rule == "argmax" else D.confidence_abs_max("score")
        out = scored.withColumn("pred", pred).withColumn("confidence", np_round(conf, 4))
    else:
        pred = D.argmax("proba") if rule == "argmax" else D.decide_threshold("proba", m["threshold"] or 0.5)
        out = scored.withColumn("pred", pred)
        conf = F.array_max("proba") if rule == "argmax" else D.confidence_chosen("proba", "pred")
        out = D.proba_columns(out.withColumn("confidence", np_round(conf, 4)), "proba")
    keep = [c for c in ["window_idx", "time_start", "time_end", "rep_src_ip", "rep_dst_ip", "rep_dst_port",
                        "pkt_count", "byte_total", "flow_duration", "Label"] if c in windows.columns]
    probas = [c for c in out.columns if c.startswith("proba_")]
    return out.select(*keep, D.prediction_name("pred").alias("prediction"), "confidence", *probas)
