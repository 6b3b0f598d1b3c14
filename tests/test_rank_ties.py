"""W0 with heavily tied values: ranks, even buckets, and a plan that does not grow with the buckets."""

import random

from flowlens.operators.rank import add_order_bucket, packet_rank


def tied(spark):
    rng = random.Random(1)
    rows = [(float(rng.choice([1, 1, 1, 1, 2, 3, rng.random() * 10])), i) for i in range(4000)] + [(7.5, i) for i in range(4000, 7000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "t double, no bigint")


def test_ranks_of_ties(spark):
    rows, df = tied(spark)
    got = [(r.t, r.no) for r in packet_rank(df, ("t", "no"), num_buckets=32).orderBy("rank").collect()]
    assert got == sorted(rows)


def test_each_tied_value_is_split_by_its_own_weight(spark):
    rows, df = tied(spark)
    sizes = [r["count"] for r in add_order_bucket(df, "t", "no", 32).groupBy("_bkt").count().collect()]
    assert max(sizes) < 2 * len(rows) / 32 and len(sizes) < 2 * 32


def test_plan_does_not_grow_with_the_buckets(spark):
    _, df = tied(spark)
    size = lambda n: len(add_order_bucket(df, "t", "no", n)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(256) - size(32)) < 50
