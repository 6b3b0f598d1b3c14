"""ML learns a learnable fixture: synthetic windows whose features depend on the class
(test-only generator, shaped like the window table)."""

import numpy as np
import pandas as pd

from flowlens.constants import FEATURE_COLS
from flowlens.operators import ml


def synth_features(n_per_class: int = 370, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for label in range(5):
        df = pd.DataFrame({c: rng.normal(0.0, 1.0, n_per_class) for c in FEATURE_COLS})
        df["pkt_count"] = 100
        # class-dependent signals, as in the reference's demo generator shape
        df["syn_ratio"] = rng.normal([0.1, 0.9, 0.5, 0.2, 0.3][label], 0.05, n_per_class)
        df["n_unique_dports"] = rng.normal([3, 2, 80, 10, 1][label], 1.0, n_per_class)
        df["rst_ratio"] = rng.normal([0.05, 0.05, 0.4, 0.1, 0.6][label], 0.03, n_per_class)
        df["Label"] = label
        frames.append(df)
    out = pd.concat(frames, ignore_index=True).sample(frac=1.0, random_state=seed).reset_index(drop=True)
    out.insert(0, "window_idx", np.arange(len(out)) * 10)
    return out


def test_models_learn_synthetic_windows(spark):
    w = spark.createDataFrame(synth_features())
    tr = ml.train_all(w, ["Random Forest", "Decision Tree"], ensemble=False)
    for name in ("Random Forest", "Decision Tree"):
        r = tr["results"][name]
        assert r["report"]["accuracy"]["f1"] > 0.9, name
        assert r["roc_auc"] is None or r["roc_auc"] > 0.9
    imp = dict(tr["results"]["Random Forest"]["fi"])
    top3 = sorted(imp, key=imp.get, reverse=True)[:3]
    assert set(top3) == {"syn_ratio", "n_unique_dports", "rst_ratio"}
