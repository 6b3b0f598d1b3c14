"""Forests: the trees do not travel with every pass, and the evaluation reads scores that were written once."""

from flowlens.constants import CLASS_NAMES, FEATURE_COLS
from flowlens.operators import ml


def test_evaluation_reads_written_scores(spark, monkeypatch):
    rows = [(i, i % 2, *[float((i * (j + 3)) % 17 + 20 * (i % 2)) for j in range(len(FEATURE_COLS))]) for i in range(200)]
    w = spark.createDataFrame(rows, "window_idx long, Label int, " + ", ".join(f"{c} double" for c in FEATURE_COLS))
    seen, run = [], ml.evaluate_scored

    def spy(scored, kind, tune=None):
        seen.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (scored, tune) if df is not None)
        return run(scored, kind, tune)

    monkeypatch.setattr(ml, "evaluate_scored", spy)
    small = {k: v for k, v in ml.model_defs(140).items() if k in ("Random Forest", "Logistic Regression")}
    assert small["Random Forest"][0].getCacheNodeIds()
    assert (small["Random Forest"][0].getNumTrees(), small["Random Forest"][0].getMaxDepth()) == (100, 20)
    small["Random Forest"][0].setNumTrees(5)
    monkeypatch.setattr(ml, "model_defs", lambda *_: small)
    got = ml.train_all(w, tune_on="train")["results"]
    assert len(seen) == 6 and not any("UDF" in plan for plan in seen)
    assert all(r["report"]["accuracy"]["f1"] == 1.0 for r in got.values()) and len(CLASS_NAMES) >= 2


def test_fits_run_on_few_partitions_of_written_rows(spark, monkeypatch):
    assert ml.fit_partitions(200, 5, 12) == 5 and ml.fit_partitions(6_919, 200, 12) == 4  # not 200 copies of the nodes' statistics
    assert ml.fit_partitions(69_190, 200, 12) == 12 and ml.fit_partitions(6_000_000, 200, 12) == 120
    assert ml.fit_partitions(6_000_000, 16, 12) == 16  # never more than there are
    rows = [(i, i % 2, *[float((i * (j + 3)) % 17 + 20 * (i % 2)) for j in range(len(FEATURE_COLS))]) for i in range(200)]
    w = spark.createDataFrame(rows, "window_idx long, Label int, " + ", ".join(f"{c} double" for c in FEATURE_COLS)).repartition(5)
    seen = []
    small = ml.model_defs(140)["Random Forest"]
    small[0].setNumTrees(3)
    monkeypatch.setattr(ml, "FIT_ROWS", 150)
    assert small[0].getCheckpointInterval() == 2
    fit = type(small[0]).fit
    monkeypatch.setattr(type(small[0]), "fit", lambda self, df: seen.append(df) or fit(self, df))
    monkeypatch.setattr(ml, "model_defs", lambda *_: {"Random Forest": small})
    ml.train_all(w, ["Random Forest"], ensemble=False)
    assert [df.rdd.getNumPartitions() for df in seen] == [2]
    assert seen[0].where("split = 'train'").count() == 140  # every row is there
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
