"""M5: the forest grown by tasks: its trees against Spark's, many rows against whole trees, votes by hand, bundles."""

import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.operators import forest, ml
from flowlens.operators.forest import ForestClassifier, ForestModel
from test_boosting import frame
from test_ml_learns import synth_features


def made(n, seed=2):
    rng = np.random.default_rng(seed)
    y = rng.choice([0, 1, 3], n, p=[0.6, 0.3, 0.1])
    x = np.round(rng.normal(0, 1, (n, 5)) + np.eye(5)[y] * 1.2, 1)
    return x, y, rng.integers(1, 4, n).astype(float)


def test_a_tree_is_the_one_of_spark(spark):
    x, y, w = made(500)
    x = np.clip(x, -1.4, 1.4)  # at most 29 values, so every value is a threshold for both
    want = DecisionTreeClassifier(maxDepth=4, weightCol="weight", labelCol="Label").fit(frame(spark, x, y, w)).transform(frame(spark, x, y, w))
    by_row = {tuple(r.features): list(r.probability) for r in want.collect()}
    edges = [forest.thresholds(*forest._merged(x[:, i], w), 32) for i in range(5)]
    bins = forest.binned(x, edges)
    tree = forest.grow(bins, y.astype(np.int32), w, 4, 5, 4, np.random.default_rng(0))
    assert (tree.feature >= 0).sum() > 8
    for row, got in zip(x, tree.votes(bins)):
        assert np.allclose(got, by_row[tuple(row)], atol=1e-6)


def test_thresholds_of_merged_summaries(monkeypatch):
    v, w = np.arange(1000.0), np.ones(1000)
    even = forest.thresholds(v, w, 32)
    assert len(even) == 31 and np.abs(np.diff(even) - 1000 / 32).max() <= 1
    monkeypatch.setattr(forest, "SKETCH", 500)
    parts = [forest._merged(v[i::3], w[i::3]) for i in range(3)]
    sums = forest._merged(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
    assert len(sums[0]) <= 500 and sums[1].sum() == 1000
    assert np.abs(forest.thresholds(*sums, 32) - even).max() <= 8
    assert list(forest.thresholds(np.array([1.0, 2.0, 9.0]), np.ones(3), 32)) == [1.5, 5.5]
    assert list(forest.binned(np.array([[1.5], [1.6], [np.nan], [np.inf]]), [np.array([1.5, 5.5])])[:, 0]) == [0, 1, 2, 2]


@pytest.fixture
def classifier(monkeypatch):
    monkeypatch.setattr(forest, "SPARK_ROWS", 50)
    return lambda **more: ForestClassifier(numTrees=6, maxDepth=20, seed=7, weightCol="weight", labelCol="Label", **more)


def probabilities(model, df):
    return {tuple(r.features): r.probability for r in model.transform(df).collect()}


def test_nodes_of_many_rows_are_split_alike(spark, monkeypatch, classifier):
    x, y, w = made(400)
    df = frame(spark, x, y, w).cache()
    df.count()
    whole = classifier(featureSubsetStrategy="all").fit(df)
    monkeypatch.setattr(forest, "TREE_ROWS", 60)
    parts = classifier(featureSubsetStrategy="all").fit(df)
    assert whole.tops is None and all(len(t.feature) > 3 for t in parts.tops)
    a, b = probabilities(whole, df), probabilities(parts, df)
    assert np.mean([np.allclose(a[k], b[k], atol=1e-6) for k in a]) > 0.97  # sums in another order may part equal gains
    assert np.allclose(whole.importances(), parts.importances(), atol=0.02) and abs(sum(parts.importances()) - 1) < 1e-9
    drawn = classifier().fit(df)  # three of five features a node
    right = [max(range(4), key=lambda c: p[c]) == k for p, k in ((probabilities(drawn, df)[tuple(r)], k) for r, k in zip(x, y))]
    assert np.mean(right) > 0.9


def test_scores_are_the_votes_of_the_written_trees(spark, tmp_path, monkeypatch, classifier):
    x, y, w = made(300, 4)
    x[::7, 1] = np.nan
    df = frame(spark, x, y, w)
    model = classifier().fit(df)
    votes = np.mean([t.votes(forest.binned(x, model.edges)) for _, _, t in forest._units(f"{model.path}/units", model.classes)], axis=0)
    assert np.allclose(votes.sum(axis=1), 1, atol=1e-6)
    model.save(str(tmp_path / "m"))
    monkeypatch.setattr(forest, "SCORE_ROWS", 20)
    again = ForestModel.load(str(tmp_path / "m"))
    got = {repr(list(map(float, r.features))): r.probability for r in again.transform(df).collect()}
    assert all(np.allclose(got[repr(list(map(float, r)))], v, atol=1e-9) for r, v in zip(x, votes)) and again.gains == model.gains
    with pytest.raises(ValueError):
        classifier().fit(frame(spark, x, y - 1, w))


def test_one_class_and_equal_rows(spark, classifier):
    df = frame(spark, np.ones((60, 2)), [2] * 60, np.ones(60))
    model = classifier().fit(df)
    assert model.importances() == [0.0, 0.0] and list(model.transform(df).first().probability) == [0, 0, 1]
    mixed = classifier().fit(frame(spark, np.ones((60, 2)), [0, 1] * 30, np.ones(60)))
    assert mixed.importances() == [0.0, 0.0]


def test_the_driver_holds_no_nodes(spark, tmp_path, monkeypatch):
    """Fitted windows beyond SPARK_ROWS: before, the model was Spark's, all of its nodes on the driver."""
    monkeypatch.setattr(forest, "SPARK_ROWS", 100)
    windows = spark.createDataFrame(pd.concat([synth_features(60)]))
    tr = ml.train_all(windows, ["Random Forest"], ensemble=False)
    model = tr["models"]["Random Forest"][0]
    assert isinstance(model, ForestModel) and len(pickle.dumps(model)) < 20_000
    assert tr["results"]["Random Forest"]["macro_f1"] > 0.9 and len(tr["results"]["Random Forest"]["fi"]) == len(FEATURE_COLS)
    ml.save_bundle(str(tmp_path / "b"), tr, "Random Forest")
    out = ml.score_windows(ml.load_bundle(spark, str(tmp_path / "b")), windows, "Random Forest", rule="argmax").collect()
    names = [CLASS_NAMES[r.Label] == r.prediction for r in out]
    assert len(out) == windows.count() and np.mean(names) > 0.9
