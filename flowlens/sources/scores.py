"""Test adapter: a deterministic scored table derived from ``events``.

True class from event_type; five raw scores from event_id and value, with a margin on
the true class; probabilities = scores / their sum; decision scores centred on 0.
Same definition as the oracle SQL (flowlens.plans.queries_eval).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: event type -> class id of the test scores.
EVENT_CLASS = {"click": 0, "view": 1, "purchase": 2, "signup": 3, "error": 4}


def scored_from_events(events: DataFrame) -> DataFrame:
    y = F.lit(None).cast("int")
    for e, c in EVENT_CLASS.items():
        y = F.when(F.col("event_type") == e, F.lit(c)).otherwise(y)
    base = events.select("event_id", "ts", y.alias("y"), F.floor(F.col("value") * 100).cast("bigint").alias("_v"))
    raw = [
        (((F.col("event_id") * (2 * j + 3) + F.col("_v")) % 101 + 1).cast("double")
         + F.when(F.col("y") == j, F.lit(80.0)).otherwise(F.lit(0.0)))
        for j in range(5)
    ]
    tot = raw[0] + raw[1] + raw[2] + raw[3] + raw[4]
    return base.select(
        "event_id", "ts", "y",
        F.array(*[r / tot for r in raw]).alias("proba"),
        F.array(*[(r - F.lit(100.0)) / F.lit(50.0) for r in raw]).alias("score"),
    )
