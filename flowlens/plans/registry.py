"""Registry of named queries: a Spark plan, its DuckDB oracle SQL, its double columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.plans.oracle import round_sql

DIGITS = 6


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, list(doubles or []))
        return fn

    return deco


def round_doubles(df: DataFrame, names: list[str] | None = None, digits: int = DIGITS) -> DataFrame:
    """Round the named floating columns (all of them when ``names`` is None), the same
    rule as the oracle side. Columns computed by identical IEEE operations in both
    engines (e.g. histogram edges) are left exact."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (names is None or f.name in names):
            # rint(x * 10^d) / 10^d: the same IEEE operations as the oracle's
            # round_even(x * 10^d, 0) / 10^d, so equal inputs give equal outputs
            scale = float(10 ** digits)
            cols.append((F.rint(F.col(f"`{f.name}`").cast("double") * scale) / scale).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(q: Query):
        return lambda spark, sf_dir: round_doubles(q.build(spark, sf_dir), q.doubles)

    return {name: wrap(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    return {name: round_sql(q.sql, q.doubles, DIGITS) for name, q in REGISTRY.items() if q.sql}
