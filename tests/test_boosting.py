"""M9: one round against a search by hand over all cuts, the softmax fit, absent classes, scoring through a saved bundle."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.operators import boosting, ml
from flowlens.operators.boosting import BoostedTrees, BoostedTreesModel
from test_ml_learns import synth_features


def frame(spark, x, label, weight):
    rows = [([float(v) for v in r], int(k), float(q)) for r, k, q in zip(x, label, weight)]
    return spark.createDataFrame(rows, "x array<double>, Label int, weight double").repartition(3).select(
        array_to_vector(F.col("x")).alias("features"), "Label", "weight")


def by_hand(x, g, h, depth, lam=1.0, least=1.0, rate=0.1):
    """Row-wise values of one regression tree grown by trying every value of every feature as a cut."""
    out = np.full(len(x), -rate * g.sum() / (h.sum() + lam))
    if depth == 0:
        return out
    best = (1e-6, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[1:]:
            left = x[:, f] < cut
            if h[left].sum() < least or h[~left].sum() < least:
                continue
            gain = sum(g[s].sum() ** 2 / (h[s].sum() + lam) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + lam)
            if gain > best[0] + 1e-9:
                best = (gain, left)
    if best[1] is None:
        return out
    for side in (best[1], ~best[1]):
        out[side] = by_hand(x[side], g[side], h[side], depth - 1, lam, least, rate)
    return out


@pytest.mark.parametrize("task_rows", [50, 1 << 18])
def test_rounds_match_a_search_by_hand(spark, monkeypatch, task_rows):
    """Few distinct values, so that every value is an edge; several tasks and several rounds between written margins."""
    monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
    rng = np.random.default_rng(3)
    label = rng.choice([0, 2, 3], 180, p=[0.5, 0.3, 0.2])
    x = np.round(rng.normal(0, 1, (180, 3)) + np.eye(4)[label][:, [0, 2, 3]] * 1.3, 1)
    weight = np.array([180 / (3 * (label == c).sum()) for c in label])
    model = BoostedTrees(rounds=3, depth=3, keep=2).fit(frame(spark, x, label, weight))
    margin = np.zeros((180, 3))
    for _ in range(3):
        p = boosting.softmax(margin)
        margin = margin + np.stack([by_hand(x, weight * (p[:, i] - (label == c)), 2 * weight * p[:, i] * (1 - p[:, i]), 3)
                                    for i, c in enumerate([0, 2, 3])], axis=1)
    want = boosting.softmax(margin)
    got = model.transform(frame(spark, x, label, weight)).select("features", "probability").collect()
    by_row = {tuple(r): q for r, q in zip(x.tolist(), want.tolist())}
    for r in got:
        assert r.probability[1] == 0 and r.probability[4] == 0
        assert np.allclose([r.probability[c] for c in (0, 2, 3)], by_row[tuple(r.features.toArray().tolist())], atol=1e-9)


def test_one_class_missing_values_and_no_rows(spark):
    x = np.array([[1.0, np.nan], [2.0, 5.0], [3.0, np.nan]])
    model = BoostedTrees(rounds=2, depth=2).fit(frame(spark, x, [3, 3, 3], [1, 1, 1]))
    got = model.transform(frame(spark, x, [3, 3, 3], [1, 1, 1])).collect()
    assert [list(r.probability) for r in got] == [[0, 0, 0, 1, 0]] * 3
    assert model.importances() == [0.0, 0.0]
    with pytest.raises(ValueError):
        BoostedTrees().fit(frame(spark, x[:0], [], []))


def test_learns_and_votes_through_a_bundle(spark, tmp_path):
    windows = spark.createDataFrame(synth_features(120))
    tr = ml.train_all(windows, ["Logistic Regression", "Gradient Boosting"], boost_rounds=6)
    res = tr["results"]["Gradient Boosting"]
    assert res["macro_f1"] > 0.9 and abs(sum(v for _, v in res["fi"]) - 1) < 1e-9
    assert {c for c, v in res["fi"] if v > 0.05} <= {"syn_ratio", "n_unique_dports", "rst_ratio"}
    ens = "Ensemble (Soft Voting)"
    assert tr["results"][ens]["members"] == ["Logistic Regression", "Gradient Boosting"]
    ml.save_bundle(str(tmp_path / "b"), tr, ens)
    bundle = ml.load_bundle(spark, str(tmp_path / "b"))
    again: BoostedTreesModel = bundle["models"]["Gradient Boosting"][0]
    old = tr["models"]["Gradient Boosting"][0]
    assert (again.trees.value == old.trees.value).all() and (again.trees.cut == old.trees.cut).all()
    assert (again.trees.feature == old.trees.feature).all() and again.gains == old.gains
    out = {r.window_idx: r for r in ml.score_windows(bundle, windows, ens).collect()}
    # the vote and its stored threshold once more, in plain Python on the members' probabilities
    z = ml.assemble(ml.feature_columns(ml.apply_scaler(windows, bundle["stats"])), out="features")
    z = ml.assemble(z, out="scaled", prefix="_z_")
    t = bundle["meta"]["models"][ens]["threshold"]
    parts = [{r.window_idx: list(r.proba) for r in ml.class_scores(*bundle["models"][m], z).select("window_idx", "proba").collect()}
             for m in ("Logistic Regression", "Gradient Boosting")]
    assert len(FEATURE_COLS) == len(res["fi"])
    for w, r in out.items():
        p = [(a + b) / 2 for a, b in zip(parts[0][w], parts[1][w])]
        want = 0 if p[0] >= t else 1 + int(np.argmax(p[1:]))
        assert r.prediction == CLASS_NAMES[want]
