"""Flow statistics on literal counter rows, against rows worked out by hand."""

from pyspark.sql import functions as F

from flowlens.functions.packet import time_label
from flowlens.operators.flows import flow_statistics

SCHEMA = ("reply_id bigint, timestamp double, datapath_id bigint, eth_type int, ipv4_src string, ipv4_dst string, "
          "ip_proto int, icmpv4_code int, icmpv4_type int, tcp_src int, tcp_dst int, udp_src int, udp_dst int, "
          "duration_sec bigint, duration_nsec bigint, idle_timeout int, hard_timeout int, flags int, "
          "packet_count bigint, byte_count bigint, priority int, entry_no bigint")

ROWS = [
    # one reply: ICMP first, then UDP and TCP; a priority-0 entry; zero durations
    (1, 10.0, 1, 2048, "10.0.0.1", "10.0.0.2", 1, 0, 8, None, None, None, None, 5, 100, 0, 0, 0, 10, 980, 1, 1),
    (1, 10.0, 1, 2048, "10.0.0.1", "10.0.0.3", 17, None, None, None, None, 5353, 53, 0, 5, 0, 0, 0, 3, 300, 1, 2),
    (1, 10.0, 1, 2048, "10.0.0.2", "10.0.0.3", 6, None, None, 40000, 80, None, None, 2, 0, 0, 0, 0, 7, 700, 1, 3),
    (1, 10.0, 1, 2048, "10.0.0.4", "10.0.0.5", 6, None, None, 40001, 22, None, None, 3, 7, 0, 0, 0, 9, 900, 0, 4),
    (2, 20.0, 1, 2048, "10.0.0.9", "10.0.0.8", 17, None, None, None, None, 1234, 4321, 1, 1, 0, 0, 0, 4, 400, 1, 5),
]


# worked out by hand from the rows above: flow id, ports, ICMP code and type, packets per s and ns, bytes per s and ns
ICMP = ("10.0.0.1010.0.0.201", 0, 0, 0, 8, 2.0, 0.1, 196.0, 9.8)
TCP = ("10.0.0.24000010.0.0.3806", 40000, 80, -1, -1, 0.0, 0.0, 0.0, 0.0)  # no nanoseconds: all rates 0
UDP = ("10.0.0.1535310.0.0.35317", 5353, 53, -1, -1, 0.0, 0.0, 0.0, 0.0)  # no seconds: all rates 0
LATE = ("10.0.0.9123410.0.0.8432117", 1234, 4321, -1, -1, 4.0, 4.0, 400.0, 400.0)


def after_icmp(row):
    """The same row with the ICMP fields of the first entry of its reply carried on."""
    return (*row[:3], 0, 8, *row[5:])


def test_flow_statistics_of_literal_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = {False: [ICMP, UDP, TCP, LATE], True: [ICMP, after_icmp(UDP), after_icmp(TCP), LATE]}
    for carry, rows in want.items():
        got = flow_statistics(df, carry_forward=carry).select(
            "flow_id", "tp_src", "tp_dst", "icmp_code", "icmp_type", "packet_count_per_second",
            "packet_count_per_nsecond", "byte_count_per_second", "byte_count_per_nsecond").collect()
        assert sorted(tuple(r) for r in got) == sorted(rows)


def test_time_label_epoch_and_relative(spark):
    vals = [1704067200.0 + 3723.5, 12.345, 2.675, 0.125, 1234.565]
    df = spark.createDataFrame([(v,) for v in vals], "t double")
    got = [r[0] for r in df.select(time_label("t")).collect()]
    assert got == ["01:02:03"] + [f"{v:.2f}s" for v in vals[1:]]
