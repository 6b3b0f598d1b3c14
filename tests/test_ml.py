"""ML: the tuned threshold is the brute-force optimum; bundle round trip keeps predictions."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from flowlens.operators import decide as D
from flowlens.operators import evaluate as EV
from flowlens.plans.queries_eval import scored


def test_threshold_search_matches_brute_force(spark):
    s = scored(spark, SF_SMALL).cache()
    table = {round(r["t"], 9): r["macro_f1"] for r in EV.threshold_table(s).collect()}
    for t in EV.grid(EV.THRESHOLD_GRID):
        p = s.withColumn("pred", D.decide_threshold("proba", t))
        rep = {r["cls"]: r for r in EV.class_report(p).collect()}
        assert abs(rep["macro avg"]["f1"] - table[round(t, 9)]) < 1e-12


def test_predict_rf_bundle_round_trip(spark):
    out = E.queries()["predict_rf"](spark, SF_SMALL)
    assert out.count() > 0
    assert {"prediction", "confidence"} <= set(out.columns)
    assert out.where(F.col("confidence").isNull()).count() == 0
