"""The registered queries: one per operator of the inventory, over the test tables.

Inputs are the driver's tables; packets come from ``events`` through the adapter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.clean import clean_packets
from flowlens.operators.packet_features import packet_features
from flowlens.operators.windows import window_features
from flowlens.plans import oracle as O
from flowlens.plans.registry import register
from flowlens.session import materialize
from flowlens.sources.packets import packets_from_events

WINDOW_DOUBLES = O.WINDOW_DOUBLES


def clean(spark: SparkSession, sf_dir: str, length_policy: str = "zero") -> DataFrame:
    return clean_packets(packets_from_events(spark, sf_dir), length_policy)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet features written once: the rank boundaries, counts and the window job then
    read them instead of recomputing scan, parse and the per-flow IAT."""
    return materialize(packet_features(clean(spark, sf_dir)))


# ---------------------------------------------------------------- windows
@register(
    "window_features",
    O.with_ctes(O.PACKETS, O.CLEAN_ZERO, O.feat_cte(), O.windows_sql("feat"), final="SELECT * FROM windows"),
    WINDOW_DOUBLES,
)
def q_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_features(features(spark, sf_dir))


@register(
    "window_features_explode",
    O.with_ctes(O.PACKETS, O.CLEAN_ZERO, O.feat_cte(), O.windows_sql("feat"), final="SELECT * FROM windows"),
    WINDOW_DOUBLES,
)
def q_window_features_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_features(features(spark, sf_dir), method="explode")
import flowlens.plans.queries_prep  # noqa: E402,F401
import flowlens.plans.queries_eda  # noqa: E402,F401
import flowlens.plans.queries_eval  # noqa: E402,F401
import flowlens.plans.queries_ml  # noqa: E402,F401
import flowlens.plans.queries_stream  # noqa: E402,F401
import flowlens.plans.queries_more  # noqa: E402,F401
