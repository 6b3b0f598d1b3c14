"""M8: the Newton fit against the optimality condition of its objective, and scoring through a saved bundle."""

import numpy as np

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.operators import ml
from flowlens.operators.svm import LinearOvrModel, LinearOvrSvm
from test_ml_learns import synth_features


def gradient(x, label, weight, k, w, c=1.0):
    """Gradient of 1/2 |w|^2 + c * weighted squared hinge losses, row by row."""
    g = np.array(w, dtype=float)
    for row, y0, own in zip(x, label, weight):
        z = np.r_[row, 1.0]
        y = 1.0 if y0 == k else -1.0
        short = 1.0 - y * z @ w
        if short > 0:
            g -= 2 * c * (own if y0 == k else 1.0) * y * short * z
    return g


def frame(spark, x, label, weight):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    rows = [([float(v) for v in r], int(k), float(q)) for r, k, q in zip(x, label, weight)]
    return spark.createDataFrame(rows, "x array<double>, Label int, weight double").repartition(3).select(
        array_to_vector(F.col("x")).alias("scaled"), "Label", "weight")


def test_fit_is_the_optimum(spark, tmp_path):
    """The objective is 1-strongly convex: the distance to its optimum is at most the norm of the gradient."""
    rng = np.random.default_rng(8)
    label = rng.choice([0, 1, 3], 240, p=[0.6, 0.3, 0.1])
    x = rng.normal(0, 1, (240, 4)) + np.eye(4)[label] * 1.5
    weight = np.array([240 / (3 * (label == k).sum()) for k in label])
    model = LinearOvrSvm().fit(frame(spark, x, label, weight))
    assert sorted(model.coefficients) == [0, 1, 3] and model.passes < 30
    for k, w in model.coefficients.items():
        assert np.linalg.norm(gradient(x, label, weight, k, np.array(w))) < 1e-3
    model.save(str(tmp_path / "svm"))
    again = LinearOvrModel.load(str(tmp_path / "svm"))
    assert again == model
    got = again.transform(frame(spark, x, label, weight)).select("scaled", "rawPrediction").collect()
    for r in got:
        z = np.r_[r.scaled.toArray(), 1.0]
        want = [z @ np.array(model.coefficients[k]) if k in model.coefficients else -1e300 for k in range(5)]
        assert np.allclose(r.rawPrediction, want)


def test_learns_and_scores_through_a_bundle(spark, tmp_path):
    windows = spark.createDataFrame(synth_features(120))
    tr = ml.train_all(windows, ["SVM (Linear)"], ensemble=False)
    res = tr["results"]["SVM (Linear)"]
    assert res["macro_f1"] > 0.9 and len(res["fi"]) == len(FEATURE_COLS)
    ml.save_bundle(str(tmp_path / "b"), tr, "SVM (Linear)")
    bundle = ml.load_bundle(spark, str(tmp_path / "b"))
    out = {r.window_idx: r for r in ml.score_windows(bundle, windows.withColumn("time_start", windows.window_idx * 1.0)).collect()}
    # the stored rule once more, in plain Python on the decision values
    z = ml.assemble(ml.feature_columns(ml.apply_scaler(windows, bundle["stats"])), out="scaled", prefix="_z_")
    bias = bundle["meta"]["models"]["SVM (Linear)"]["bias"]
    model = bundle["models"]["SVM (Linear)"][0]
    for r in model.transform(z).select("window_idx", "rawPrediction").collect():
        s = list(r.rawPrediction)
        s[0] += bias
        assert out[r.window_idx].prediction == CLASS_NAMES[int(np.argmax(s))]


def test_one_tie_rule():
    names = ["b", "Ensemble (Soft Voting)", "a", "c"]
    assert ml.select_model(names, "c") == ["Ensemble (Soft Voting)", "c", "a", "b"]
