"""Representative values by one walk over a window's sorted values; the dashboard's packets are written once."""

import random
from collections import Counter

from pyspark.sql import functions as F

from flowlens.operators import windows as W
from flowlens.plans import queries_more
from conftest import SF_SMALL


def test_modes_by_hand_without_a_lambda_per_pair(spark):
    rng = random.Random(1)
    rows = [([rng.choice([None, 1, 2, 3, 40, 500]) for _ in range(n)], [rng.choice([None, "a", "b", "10.0.0.9", "10.0.0.10"]) for _ in range(n)])
            for n in [*range(12), 100, 100]] + [([None], [None]), (None, None)]
    df = spark.createDataFrame(rows, "a array<int>, s array<string>").select("*", W._array_mode(F.col("a")).alias("x"), W._array_mode(F.col("s")).alias("y"))

    def mode(values):
        n = Counter(v for v in values or [] if v is not None)
        return min(n, key=lambda v: (-n[v], v)) if n else None

    assert [(r.x, r.y) for r in df.collect()] == [(mode(a), mode(s)) for a, s in rows]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "aggregate(" in plan and "transform(" not in plan and "array_distinct(" not in plan


def test_dashboard_packets_are_read_as_written(spark):
    plan = queries_more.dashboard_windows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and "LogicalRDD" in plan
