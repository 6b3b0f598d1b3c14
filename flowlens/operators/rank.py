"""Global (or per-key) position of each row in a total order, without a
single-partition window.

Plan (all Spark jobs, nothing unbounded on the driver):

1. Bucket boundaries: ``percentile_approx`` of the primary order column at
   ``k / num_buckets``. One pass, bounded sketch, ``num_buckets - 1`` values collected.
2. Heavy ties: a value returned for several quantiles holds more than one bucket's
   worth of rows on its own. For those values only, secondary boundaries on the
   tie-break column are taken the same way, so a timestamp shared by a third of all
   rows is still spread over many buckets.
3. Bucket id: ``Bucketizer`` (binary search, JVM side) on the primary column, refined
   by the tie-break boundaries. The bucket order is consistent with the row order.
4. ``groupBy(key, bucket).count()`` -> prefix sums over that small table -> join back
   -> ``row_number`` partitioned by (key, bucket) + offset.

Any boundaries give the same ranks, so the approximation is harmless; they are
collected once and enter the plan as a model and a small broadcast table, so re-execution
after an executor loss gives the same buckets and the plan does not grow with them.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bkt"


def default_buckets(df: DataFrame) -> int:
    """Order buckets: ``flowlens.rank.buckets`` when set (size it so a bucket holds a few
    million rows), else 4 x shuffle partitions. Any value gives the same ranks."""
    conf = df.sparkSession.conf
    explicit = conf.get("flowlens.rank.buckets", None)
    if explicit:
        return max(2, int(explicit))
    n = int(conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, 4 * n)


def add_order_bucket(
    df: DataFrame, primary: str, tiebreak: str, num_buckets: int | None = None, accuracy: int = 100000
) -> DataFrame:
    """Add a column ``_bkt`` (bigint) such that (primary, tiebreak) order implies bucket order."""
    nb = num_buckets or default_buckets(df)
    fracs = [k / nb for k in range(1, nb)]
    row = df.agg(F.percentile_approx(F.col(primary).cast("double"), fracs, accuracy).alias("q")).first()
    qs = [q for q in (row["q"] or []) if q is not None]
    dist = sorted(set(qs))
    mult = Counter(qs)
    heavy = sorted(v for v, c in mult.items() if c > 1)

    splits = [float("-inf")] + dist + [float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    tmp_in, tmp_out = "_bk_in", "_bk_j"
    staged = df.withColumn(tmp_in, F.col(primary).cast("double"))
    staged = Bucketizer(splits=splits, inputCol=tmp_in, outputCol=tmp_out, handleInvalid="keep").transform(staged)
    j = F.col(tmp_out).cast("bigint")

    if not heavy:
        return staged.withColumn(BUCKET, j).drop(tmp_in, tmp_out)

    # secondary boundaries for the heavy values, as many for each as it fills buckets: together at most num_buckets,
    # kept as small tables, so the plan does not grow with them
    m = max(mult[h] for h in heavy)
    spark = df.sparkSession
    counts = spark.createDataFrame([(float(v), mult[v]) for v in heavy], "v double, c int")
    tied = df.select(F.col(primary).cast("double").alias("v"), F.col(tiebreak).alias("t")).join(F.broadcast(counts), "v")
    fine = tied.groupBy("v", "c").agg(F.percentile_approx("t", [i / (m + 1) for i in range(1, m + 1)], accuracy).alias("q"))
    own = F.transform(F.sequence(F.lit(1), F.col("c")),
                      lambda i: F.element_at("q", F.ceil(i * F.lit((m + 1.0)) / (F.col("c") + 1) - 1e-9).cast("int")))
    sub_rows = fine.select("v", F.sort_array(F.array_distinct(own)).alias("b")).collect()
    width = max(len(r["b"]) for r in sub_rows) + 1
    kind = dict(df.dtypes)[tiebreak]
    bounds = spark.createDataFrame([(r["v"], r["b"]) for r in sub_rows], f"_bk_v double, _bk_b array<{kind}>")
    staged = staged.join(F.broadcast(bounds), F.col(tmp_in) == F.col("_bk_v"), "left")
    # rows equal to a heavy value come first in their interval, split by the tie-break;
    # larger values of the same interval come after all of them
    tb = F.col(tiebreak)
    sub = F.when(F.col("_bk_b").isNotNull(), F.size(F.filter("_bk_b", lambda x: x <= tb))).otherwise(F.lit(width))
    return staged.withColumn(BUCKET, j * F.lit(width + 1) + sub.cast("bigint")).drop(tmp_in, tmp_out, "_bk_v", "_bk_b")


def packet_rank(
    df: DataFrame,
    order_by: tuple[str, str] = ("time", "no"),
    rank_col: str = "rank",
    keys: list[str] | None = None,
    total_col: str | None = None,
    num_buckets: int | None = None,
) -> DataFrame:
    """0-based position in (order_by) order, globally or within ``keys``.

    ``total_col`` adds the row count of the (key) group, taken from the same small
    count table (no extra scan).
    """
    keys = list(keys or [])
    primary, tiebreak = order_by
    b = add_order_bucket(df, primary, tiebreak, num_buckets)
    counts = b.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(*keys).orderBy(BUCKET)
    offsets = counts.select(
        *keys, BUCKET,
        (F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cnt")).alias("_off"),
        *( [F.sum("_cnt").over(Window.partitionBy(*keys)).alias(total_col)] if total_col else [] ),
    )
    if not keys:
        # at most num_buckets * (width + 1) rows: a proven bound, broadcast is safe
        offsets = F.broadcast(offsets)
    # keyed: size grows with the number of keys, so AQE decides from runtime statistics
    joined = b.join(offsets, on=[*keys, BUCKET], how="inner")
    w = Window.partitionBy(*keys, BUCKET).orderBy(F.col(primary), F.col(tiebreak))
    return joined.withColumn(rank_col, (F.row_number().over(w) - 1 + F.col("_off")).cast("bigint")).drop(BUCKET, "_off")



def running_sums(
    df: DataFrame,
    sums: dict[str, Column],
    order_by: tuple[str, str],
    keys: list[str] | None = None,
    num_buckets: int | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums of several expressions in (order_by) order, per key,
    with the same two-level plan as ``packet_rank`` (bucket totals -> prefix over the
    small totals table -> bucket-local window + offset). ``totals`` adds, for some of the sums,
    a column (sum name -> column name) with the final value, from the same totals table."""
    keys = list(keys or [])
    primary, tiebreak = order_by
    staged = df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()])
    b = add_order_bucket(staged, primary, tiebreak, num_buckets)
    tot = b.groupBy(*keys, BUCKET).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    wk = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, BUCKET, *[F.coalesce(F.sum(f"_t_{n}").over(wk), F.lit(0)).alias(f"_o_{n}") for n in sums],
                      *[F.sum(f"_t_{n}").over(Window.partitionBy(*keys)).alias(c) for n, c in (totals or {}).items()])
    if not keys:
        offs = F.broadcast(offs)
    j = b.join(offs, on=[*keys, BUCKET], how="inner")
    w = Window.partitionBy(*keys, BUCKET).orderBy(F.col(primary), F.col(tiebreak)).rowsBetween(Window.unboundedPreceding, 0)
    out = j.select("*", *[(F.sum(f"_v_{n}").over(w) + F.col(f"_o_{n}")).alias(n) for n in sums])
    return out.drop(BUCKET, *[f"_v_{n}" for n in sums], *[f"_o_{n}" for n in sums])
