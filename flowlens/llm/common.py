"""Shared pieces: table access, lineage cuts, connected components, wide-column safety."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import ensure_checkpoint_dir


#: rows of an Arrow batch: texts are long, and Spark's default of 10,000 would fill a worker's memory
BATCH_ROWS = "500"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: rows of narrow tables that one partition of a written table holds easily
ROWS_PER_PART = 50_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and cut its lineage there.

    ``rows`` (a known bound) keeps the file count of a small table in proportion to its rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_PART)))
    return df.checkpoint(eager=True)


def release(df: DataFrame) -> DataFrame:
    """``df`` again, after what its making left behind is gone: Spark deletes the shuffle files, broadcasts and (where the cluster
    says so) checkpoints of tables that nothing refers to only when the driver collects its garbage, by itself every 30 minutes.
    A step that writes a small table from a large shuffle would else keep both until then. Tables in use stay."""
    sc = df.sparkSession.sparkContext
    gc.collect()  # Python's references to Spark's objects; a thread of py4j gives them back, once a second
    given = getattr(sc._gateway._gateway_client, "finalizer_deque", ())
    until = time.monotonic() + 3
    while given and time.monotonic() < until:
        time.sleep(0.05)
    time.sleep(0.05)
    sc._jvm.System.gc()
    return df


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(u, v) long pairs -> (node, component): the smallest node reachable, one row per node of an edge.

    Alternating large-star / small-star contraction: every round is joins and grouped minima on
    the edge table, nothing is gathered. Minima are written before they are joined back, so
    both join sides are plain exchanges and a hub node's partition can be split at run time. Rounds
    end as soon as every node points to one root: each round's tables are plans that the driver makes.
    Self loops and repeated edges are allowed; an empty table gives an empty table.
    """
    e = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    n, open_ = _unsettled(e)  # no later table has more than twice as many rows
    for _ in range(max_rounds):
        if not open_:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = cut(both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m")), n)
        large = cut(
            both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), n
        )
        m = cut(large.groupBy("u").agg(F.min("v").alias("m")), n)
        joined = large.join(m, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            m.select("u", F.col("m").alias("v"))
        )
        e = cut(small.distinct(), n)
        open_ = _unsettled(e)[1]
    if open_:
        raise RuntimeError("connected components did not settle")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(roots).distinct()


def _unsettled(e: DataFrame) -> tuple[int, int]:
    """(edges, nodes that are not settled) of (u, v) edges with u > v: a node that has two smaller neighbours, or one while it is a
    neighbour itself. Without any, all edges go from a node to the root of its component, which is the smallest node."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    r = node.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.col("up") + F.when(F.col("up") > 0, F.col("root")).otherwise(0) > 1)).first()
    return r[0], r[1]
