"""Flow statistics of the flow-counter collector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.flowstats import flow_key, flow_ports, flow_rates  # noqa: F401

OUTPUT_COLS = ["timestamp", "datapath_id", "flow_id", "ip_src", "tp_src", "ip_dst", "tp_dst", "ip_proto", "icmp_code",
               "icmp_type", "flow_duration_sec", "flow_duration_nsec", "idle_timeout", "hard_timeout", "flags",
               "packet_count", "byte_count", "packet_count_per_second", "packet_count_per_nsecond",
               "byte_count_per_second", "byte_count_per_nsecond", "label"]


def flows_from_packets(packets: DataFrame, reply_seconds: float = 10.0, datapath_id: int = 1) -> DataFrame:
    """Flow-table entries a switch would report for a packet table: one entry per
    (poll interval, eth type, src, dst, proto, transport ports) with packet/byte counters
    and duration. (Source adapter: counters derived from the packets by one aggregate.)"""
    proto = F.col("proto_num").cast("int")
    entries = packets.groupBy(
        F.floor(F.col("time") / reply_seconds).cast("bigint").alias("reply_id"),
        F.lit(2048).alias("eth_type"), F.col("source").alias("ipv4_src"), F.col("destination").alias("ipv4_dst"),
        proto.alias("ip_proto"), F.col("src_port").alias("sport"), F.col("dst_port").alias("dport"),
    ).agg(
        F.count(F.lit(1)).alias("packet_count"), F.sum("length").cast("bigint").alias("byte_count"),
        F.min("time").alias("_t0"), F.max("time").alias("_t1"),
    )
    d = F.col("_t1") - F.col("_t0")
    return entries.select(
        "reply_id",
        ((F.col("reply_id") + 1) * F.lit(float(reply_seconds))).alias("timestamp"),
        F.lit(datapath_id).cast("bigint").alias("datapath_id"),
        "eth_type", "ipv4_src", "ipv4_dst", "ip_proto",
        F.when(F.col("ip_proto") == 1, F.lit(0)).alias("icmpv4_code"),
        F.when(F.col("ip_proto") == 1, F.lit(8)).alias("icmpv4_type"),
        F.when(F.col("ip_proto") == 6, F.col("sport")).alias("tcp_src"),
        F.when(F.col("ip_proto") == 6, F.col("dport")).alias("tcp_dst"),
        F.when(F.col("ip_proto") == 17, F.col("sport")).alias("udp_src"),
        F.when(F.col("ip_proto") == 17, F.col("dport")).alias("udp_dst"),
        F.floor(d).cast("bigint").alias("duration_sec"),
        ((d - F.floor(d)) * F.lit(1e9)).cast("bigint").alias("duration_nsec"),
        F.lit(0).alias("idle_timeout"), F.lit(0).alias("hard_timeout"), F.lit(0).alias("flags"),
        "packet_count", "byte_count",
        # table-miss style entries (unknown protocol) carry priority 0 and are skipped
        F.when(F.col("ip_proto") == 0, F.lit(0)).otherwise(F.lit(1)).alias("priority"),
        F.col("sport").alias("entry_no"),
    )


def flow_statistics(entries: DataFrame, carry_forward: bool = False, label: int = 0) -> DataFrame:
    """P9 + F10-F12: keep priority-1 entries, derive ports/ICMP fields, the flow key and
    the four rates; project the 22 output columns."""
    e = entries.where(F.col("priority") == 1)
    e = flow_ports(e, carry_forward)
    e = e.withColumnRenamed("duration_sec", "flow_duration_sec").withColumnRenamed("duration_nsec", "flow_duration_nsec")
    e = flow_rates(e)
    return e.select(
        F.col("timestamp").cast("double"), "datapath_id",
        flow_key(src="ipv4_src", dst="ipv4_dst").alias("flow_id"), F.col("ipv4_src").alias("ip_src"), "tp_src", F.col("ipv4_dst").alias("ip_dst"), "tp_dst",
        "ip_proto", "icmp_code", "icmp_type", "flow_duration_sec", "flow_duration_nsec", "idle_timeout", "hard_timeout",
        "flags", "packet_count", "byte_count", "packet_count_per_second", "packet_count_per_nsecond",
        "byte_count_per_second", "byte_count_per_nsecond", F.lit(label).alias("label"))


def append_flow_stats(stats: DataFrame, path: str) -> None:
    """Append rows to the flow statistics table."""
    stats.write.mode("append").parquet(path)
