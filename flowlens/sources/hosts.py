"""The 20-row emulated host dimension (fixed size, safe to broadcast)."""

from pyspark.sql import DataFrame, SparkSession

from flowlens.constants import HOSTS


def host_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        HOSTS, "hostname string, ip string, mac string, switch_idx int, role string"
    )
