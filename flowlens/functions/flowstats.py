"""Flow-counter functions of the flow-statistics collector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flow_rates(df: DataFrame) -> DataFrame:
    """packets/bytes per second and per nanosecond of flow duration.

    If either duration field is 0, all four rates are 0 (the collector guards both pairs
    with one test).
    """
    zero = (F.col("flow_duration_sec") == 0) | (F.col("flow_duration_nsec") == 0)

    def rate(num: str, den: str) -> Column:
        return F.when(zero, F.lit(0.0)).otherwise(F.try_divide(F.col(num).cast("double"), F.col(den)))

    return df.select(
        "*",
        rate("packet_count", "flow_duration_sec").alias("packet_count_per_second"),
        rate("packet_count", "flow_duration_nsec").alias("packet_count_per_nsecond"),
        rate("byte_count", "flow_duration_sec").alias("byte_count_per_second"),
        rate("byte_count", "flow_duration_nsec").alias("byte_count_per_nsecond"),
    )


def flow_key(sep: str = "", src: str = "ip_src", dst: str = "ip_dst") -> Column:
    """ip_src, tp_src, ip_dst, tp_dst, ip_proto concatenated (no separator by default)."""
    parts = [src, "tp_src", dst, "tp_dst", "ip_proto"]
    return F.concat_ws(sep, *[F.col(p).cast("string") for p in parts])


# FIXED VALUES: defaults of the protocol-specific match fields.
ICMP_DEFAULT = -1
PORT_DEFAULT = 0


def flow_ports(df: DataFrame, carry_forward: bool = False) -> DataFrame:
    """icmp code/type for proto 1, tcp ports for 6, udp ports for 17.

    Per row: other protocols get icmp -1/-1 and ports 0/0. With ``carry_forward`` the
    collector's behaviour is reproduced: defaults are set once per reply, so a row
    without the field repeats the last value seen earlier in the same reply (rows in
    order eth_type, ipv4_src, ipv4_dst, ip_proto).
    """
    p = F.col("ip_proto")
    icmp_code = F.when(p == 1, F.col("icmpv4_code"))
    icmp_type = F.when(p == 1, F.col("icmpv4_type"))
    tp_src = F.when(p == 6, F.col("tcp_src")).when(p == 17, F.col("udp_src"))
    tp_dst = F.when(p == 6, F.col("tcp_dst")).when(p == 17, F.col("udp_dst"))
    out = df.select("*", icmp_code.alias("icmp_code"), icmp_type.alias("icmp_type"),
                    tp_src.alias("tp_src"), tp_dst.alias("tp_dst"))
    if carry_forward:
        w = (Window.partitionBy("reply_id").orderBy("eth_type", "ipv4_src", "ipv4_dst", "ip_proto", "entry_no")
             .rowsBetween(Window.unboundedPreceding, 0))
        for c in ["icmp_code", "icmp_type", "tp_src", "tp_dst"]:
            out = out.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return (
        out.fillna({"icmp_code": ICMP_DEFAULT, "icmp_type": ICMP_DEFAULT, "tp_src": PORT_DEFAULT, "tp_dst": PORT_DEFAULT})
    )
