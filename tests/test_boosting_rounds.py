"""M9: the query fits every round of the library's default; rounds run in one task grow the trees of the passes by Spark."""

import numpy as np
import pytest

from flowlens.operators import boosting, ml
from flowlens.operators.boosting import BoostedTrees
from flowlens.plans import queries_ml
from test_boosting import frame


def test_query_fits_all_rounds(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    def fit(windows, names, ensemble=True, tune_on="test", boost_rounds=100):
        seen.append(ml.model_defs(1, boost_rounds)["Gradient Boosting"][0].rounds)
        raise Stop

    monkeypatch.setattr(queries_ml, "train_windows", lambda *_: None)
    monkeypatch.setattr(ml, "train_all", fit)
    with pytest.raises(Stop):
        queries_ml.q_predict_gbt(spark, "")
    assert seen == [100]


def test_rounds_in_one_task_are_those_of_the_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    label = rng.choice([0, 1, 4], 300)
    x = rng.normal(0, 1, (300, 4)) + label[:, None] * 0.3
    df = frame(spark, x, label, np.ones(300)).coalesce(1)
    here = BoostedTrees(rounds=5, depth=4, keep=2).fit(df)
    monkeypatch.setattr(boosting, "HERE_ROWS", 0)
    passes = BoostedTrees(rounds=5, depth=4, keep=2).fit(df)
    assert (here.trees.feature == passes.trees.feature).all() and (here.trees.cut == passes.trees.cut).all()
    assert np.allclose(here.trees.value, passes.trees.value, atol=1e-12) and np.allclose(here.gains, passes.gains)
    assert (here.trees.feature >= 0).sum() > 15
