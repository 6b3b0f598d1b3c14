"""End-to-end plan: captures -> windows -> RF -> bundle -> scoring of a capture."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowlens.plans.pipeline import run_training, score_capture
from flowlens.plans.queries_prep import training_windows_plan
from flowlens.sources.packets import packets_from_events


def test_train_save_score(spark):
    w = training_windows_plan(spark, SF_SMALL)
    assert w.count() > 0
    path = tempfile.mkdtemp(prefix="flowlens-bundle-") + "/b"
    comp = run_training(w, path, ["Random Forest"], tune_on="train").collect()
    assert comp[0]["model"] in ("Random Forest", "Ensemble (Soft Voting)")
    scored = score_capture(packets_from_events(spark, SF_SMALL), path, "Random Forest")
    assert scored.count() > 0
    assert scored.where(F.col("prediction").isNull()).count() == 0


def test_downsample_after_iat_is_noop_when_nothing_is_thinned(spark):
    a = training_windows_plan(spark, SF_SMALL).select("window_idx", "IAT_total")
    b = training_windows_plan(spark, SF_SMALL, downsample_after_iat=True).select("window_idx", "IAT_total")
    assert a.exceptAll(b).count() == 0
