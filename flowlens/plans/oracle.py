"""DuckDB SQL equivalents of the Spark queries (the correctness oracle).

Built from common table expressions so each query states the same pipeline as its
Spark plan. Doubles are rounded to 6 decimals in both engines before comparison.
"""

from __future__ import annotations

WINDOW_DOUBLES = [
    "time_start", "time_end", "byte_total", "byte_mean", "byte_std", "byte_min", "byte_max", "pkt_rate",
    "byte_rate", "flow_duration", "IAT_mean", "IAT_std", "IAT_min", "IAT_max", "IAT_total", "syn_ratio",
    "ack_ratio", "fin_ratio", "rst_ratio", "psh_ratio", "protocol_entropy", "dominant_ratio",
]

PROTO_CASE = (
    "CASE protocol WHEN 'ICMP' THEN 1 WHEN 'TCP' THEN 6 WHEN 'UDP' THEN 17 WHEN 'ICMPv6' THEN 58 "
    "WHEN 'ARP' THEN 2054 WHEN 'OpenFlow' THEN 6653 WHEN 'DNS' THEN 53 WHEN 'MDNS' THEN 5353 "
    "WHEN 'HTTP' THEN 80 ELSE 0 END"
)

CLASS_CASE = (
    "CASE {c} WHEN 0 THEN 'Normal' WHEN 1 THEN 'DDoS' WHEN 2 THEN 'PortScan' WHEN 3 THEN 'Fuzzer' "
    "WHEN 4 THEN 'BruteForce' ELSE 'Class_' || CAST({c} AS VARCHAR) END"
)

PACKETS = """
packets AS (
  SELECT event_id + 1 AS no,
         (epoch_us(ts) - 1704067200000000) / 1e6 AS time,
         '10.0.0.' || CAST(user_id % 20 + 1 AS VARCHAR) AS source,
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE '10.0.0.' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 + 1 AS VARCHAR) END AS destination,
         CASE event_type WHEN 'click' THEN 'TCP' WHEN 'view' THEN 'UDP' WHEN 'purchase' THEN 'HTTP'
                         WHEN 'signup' THEN 'DNS' WHEN 'error' THEN 'SSDP' END AS protocol,
         CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE CAST(CAST(floor(value) AS INTEGER) + 40 AS VARCHAR) END AS length,
         CASE event_type
           WHEN 'click' THEN CAST(40000 + user_id AS VARCHAR) || ' > ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR)
                || CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN ' [SYN] Seq=0'
                                                                          WHEN 1 THEN ' [SYN, ACK] Seq=0'
                                                                          ELSE ' [FIN, ACK] Seq=1' END
           WHEN 'purchase' THEN CAST(40000 + user_id AS VARCHAR) || ' > 80 [PSH, ACK] Len=9'
           WHEN 'error' THEN CAST(40000 + user_id AS VARCHAR) || ' > 22 [RST] Seq=1'
           WHEN 'view' THEN CAST(50000 + user_id AS VARCHAR) || '  >  ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) || ' Len=5'
           WHEN 'signup' THEN 'Standard query A example' END AS info
  FROM events
),
packets_c AS (
  SELECT *, least(3, CAST(floor(time / 648000) AS INTEGER)) AS capture FROM packets
),
packets_x AS (
  SELECT *, time - capture * 648000.0 AS local_time FROM packets_c
)"""

CLEAN_ZERO = """
clean AS (
  SELECT no, TRY_CAST(time AS DOUBLE) AS time, source, destination, protocol,
         coalesce(TRY_CAST(trunc(TRY_CAST(length AS FLOAT)) AS INTEGER), 0) AS length,
         coalesce(info, 'nan') AS info, capture, local_time
  FROM packets_x
  WHERE destination IS NOT NULL AND TRY_CAST(time AS DOUBLE) IS NOT NULL
)"""


def feat_cte(src: str = "clean", name: str = "feat", iat_part: str = "flow_id", time_col: str = "time") -> str:
    return f"""
{name}_p AS (
  SELECT *,
         CAST({PROTO_CASE} AS SMALLINT) AS proto_num,
         coalesce(TRY_CAST(regexp_extract(info, '(\\d+)\\s*>\\s*(\\d+)', 1) AS INTEGER), -1) AS src_port,
         coalesce(TRY_CAST(regexp_extract(info, '(\\d+)\\s*>\\s*(\\d+)', 2) AS INTEGER), -1) AS dst_port,
         CAST(contains(info, 'SYN') AS TINYINT) AS flag_SYN, CAST(contains(info, 'ACK') AS TINYINT) AS flag_ACK,
         CAST(contains(info, 'FIN') AS TINYINT) AS flag_FIN, CAST(contains(info, 'RST') AS TINYINT) AS flag_RST,
         CAST(contains(info, 'PSH') AS TINYINT) AS flag_PSH, CAST(contains(info, 'URG') AS TINYINT) AS flag_URG
  FROM {src}
),
{name}_f AS (
  SELECT *, coalesce(source, 'nan') || '->' || coalesce(destination, 'nan') || ':' || CAST(dst_port AS VARCHAR)
            || '/' || CAST(proto_num AS VARCHAR) AS flow_id
  FROM {name}_p
),
{name} AS (
  SELECT *, CAST(CAST(coalesce({time_col} - lag({time_col}) OVER (PARTITION BY {iat_part} ORDER BY {time_col}, no), 0) AS FLOAT) AS DOUBLE) AS iat
  FROM {name}_f
)"""


def windows_sql(src: str, size: int = 100, step: int = 10, order: str = "time", has_labels: bool = False,
                key: str = "0") -> str:
    """CTEs computing count windows over ``src`` (packet features); the last CTE is ``windows``. With a
    ``key`` the windows are those of each key, named in a column ``key``."""
    keep = "" if key == "0" else "a.key, "
    lab_cte = ""
    lab_cols = "-1.0 AS dominant_ratio, -1 AS Label"
    lab_join = ""
    if has_labels:
        lab_cte = f""",
wl AS (SELECT key, w, label, count(*) AS c, min(rank) AS fr FROM wx GROUP BY key, w, label),
wd AS (SELECT key, w, label, c, row_number() OVER (PARTITION BY key, w ORDER BY c DESC, fr) AS k FROM wl)"""
        lab_cols = "CAST(wd.c AS DOUBLE) / a.pkt_count AS dominant_ratio, CAST(wd.label AS INTEGER) AS Label"
        lab_join = "JOIN wd ON wd.key = a.key AND wd.w = a.w AND wd.k = 1"
    return f"""
ranked AS (
  SELECT *, {key} AS key, row_number() OVER (PARTITION BY {key} ORDER BY {order}, no) - 1 AS rank,
         count(*) OVER (PARTITION BY {key}) AS n FROM {src}
),
wins AS (
  SELECT key, unnest(range(0, CASE WHEN max(n) >= {size} THEN (max(n) - {size}) // {step} + 1 ELSE 0 END)) AS w
  FROM ranked GROUP BY key
),
wx AS (
  SELECT wins.w, ranked.* FROM ranked JOIN wins ON wins.key = ranked.key AND ranked.rank BETWEEN wins.w * {step} AND wins.w * {step} + {size - 1}
),
agg AS (
  SELECT key, w, arg_min(time, rank) AS time_start, arg_max(time, rank) AS time_end, count(*) AS pkt_count,
         CAST(sum(length) AS DOUBLE) AS byte_total, avg(length) AS byte_mean, stddev_pop(length) AS byte_std,
         CAST(min(length) AS DOUBLE) AS byte_min, CAST(max(length) AS DOUBLE) AS byte_max,
         avg(iat) AS IAT_mean, stddev_pop(iat) AS IAT_std, min(iat) AS IAT_min, max(iat) AS IAT_max, sum(iat) AS IAT_total,
         CAST(sum(flag_SYN) AS BIGINT) AS SYN_count, CAST(sum(flag_ACK) AS BIGINT) AS ACK_count,
         CAST(sum(flag_FIN) AS BIGINT) AS FIN_count, CAST(sum(flag_RST) AS BIGINT) AS RST_count,
         CAST(sum(flag_PSH) AS BIGINT) AS PSH_count, CAST(sum(flag_URG) AS BIGINT) AS URG_count,
         count(DISTINCT source) AS n_unique_src, count(DISTINCT destination) AS n_unique_dst,
         count(DISTINCT flow_id) AS n_unique_flows, count(DISTINCT dst_port) AS n_unique_dports,
         count(DISTINCT src_port) AS n_unique_sports
  FROM wx GROUP BY key, w
),
wp AS (SELECT key, w, proto_num, count(*) AS c FROM wx GROUP BY key, w, proto_num),
went AS (
  SELECT wp.key, wp.w, -sum((CAST(wp.c AS DOUBLE) / agg.pkt_count) * log2(CAST(wp.c AS DOUBLE) / agg.pkt_count + 1e-9)) AS protocol_entropy
  FROM wp JOIN agg ON agg.key = wp.key AND agg.w = wp.w GROUP BY wp.key, wp.w
){lab_cte},
windows AS (
SELECT {keep}a.w * {step} AS window_idx, time_start, time_end, pkt_count, byte_total, byte_mean, byte_std, byte_min, byte_max,
       pkt_count / greatest(time_end - time_start, 1e-9) AS pkt_rate,
       byte_total / greatest(time_end - time_start, 1e-9) AS byte_rate,
       greatest(time_end - time_start, 1e-9) AS flow_duration,
       IAT_mean, IAT_std, IAT_min, IAT_max, IAT_total,
       SYN_count, ACK_count, FIN_count, RST_count, PSH_count, URG_count,
       CAST(SYN_count AS DOUBLE) / pkt_count AS syn_ratio, CAST(ACK_count AS DOUBLE) / pkt_count AS ack_ratio,
       CAST(FIN_count AS DOUBLE) / pkt_count AS fin_ratio, CAST(RST_count AS DOUBLE) / pkt_count AS rst_ratio,
       CAST(PSH_count AS DOUBLE) / pkt_count AS psh_ratio,
       CASE WHEN SYN_count > 0 AND ACK_count = 0 THEN 1 ELSE 0 END AS syn_no_ack,
       n_unique_src, n_unique_dst, n_unique_flows, n_unique_dports, n_unique_sports,
       went.protocol_entropy, {lab_cols}
FROM agg a JOIN went ON went.key = a.key AND went.w = a.w {lab_join}
)"""


def with_ctes(*ctes: str, final: str) -> str:
    body = ",".join(c.strip().rstrip(",") for c in ctes)
    return f"WITH {body}\n{final}"


def round_sql(sql: str, double_cols: list[str], digits: int = 6) -> str:
    """Wrap a query so its double columns are rounded (same rule as the Spark side)."""
    if not double_cols:
        return sql
    scale = float(10 ** digits)
    rep = ", ".join(f"round_even(CAST({c} AS DOUBLE) * {scale}, 0) / {scale} AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


# ------------------------------------------------------------------ labelled timeline
TEST_RULE = ("10.0.0.5", "10.0.0.3", 0.0, 648000.0, 1)


def labeled_ctes(rule=TEST_RULE) -> str:
    src, dst, t0, t1, lab = rule
    offs = ["SELECT 0 AS capture_ord, CAST(0.0 AS DOUBLE) AS off"]
    nxt = "CAST(0.0 AS DOUBLE)"
    for i in range(1, 4):
        nxt = f"(((SELECT m FROM mx WHERE capture_ord = {i - 1}) + {nxt}) + 1.0)"
        offs.append(f"SELECT {i}, {nxt}")
    return f"""
labeled AS (
  SELECT no, local_time AS time, source, destination, protocol, length, info, capture AS capture_ord,
         CASE capture WHEN 0 THEN 'DDoS-TCP' WHEN 1 THEN 'PortScan' WHEN 2 THEN 'Fuzzer' ELSE 'BruteForce' END AS capture_name,
         CASE WHEN capture = 0 THEN (CASE WHEN source = '{src}' AND destination = '{dst}'
                                           AND local_time >= {t0} AND local_time <= {t1} THEN {lab} ELSE 0 END)
              WHEN capture = 1 THEN 2 WHEN capture = 2 THEN 3 ELSE 4 END AS label
  FROM clean
),
mx AS (SELECT capture_ord, max(time) AS m FROM labeled GROUP BY capture_ord),
offs AS ({' UNION ALL '.join(offs)}),
timeline AS (
  SELECT labeled.*, labeled.time + offs.off AS global_time FROM labeled LEFT JOIN offs USING (capture_ord)
)"""


def downsample_cte(src: str, name: str, frac: float, min_keep: int, labels: list[int], seed: int = 42) -> str:
    lab = ", ".join(str(x) for x in labels)
    return f"""
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY (no * 7919 + {seed} * 104729) % 1000003, no) - 1 AS _r,
         count(*) OVER (PARTITION BY label) AS _nl
  FROM {src}
),
{name} AS (
  SELECT * EXCLUDE (_r, _nl) FROM {name}_r
  WHERE label NOT IN ({lab})
     OR _r < CASE WHEN _nl > {min_keep} THEN greatest(floor(_nl * CAST({frac} AS DOUBLE)), {min_keep}) ELSE _nl END
)"""


def hist_sql(src: str, value: str, bins: int, keys: list[str], name: str, density: bool = False) -> str:
    """CTEs ``{name}`` = numpy-style histogram of ``value`` in ``src`` per ``keys`` (all bins)."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    using = f"USING ({k})" if keys else "ON TRUE"
    gb = f"GROUP BY {k}" if keys else ""
    dens = f", coalesce(c.c, 0) / (g.n * ((g.hi - g.lo) / {float(bins)})) AS density" if density else ""
    gk = ", ".join(f"g.{x}" for x in keys)
    gkc = (gk + ", ") if keys else ""
    on_c = " AND ".join([f"c.{x} = g.{x}" for x in keys] + ["c.bin = g.bin"])
    return f"""
{name}_v AS (SELECT {kc}CAST({value} AS DOUBLE) AS x FROM {src} WHERE {value} IS NOT NULL),
{name}_r AS (
  SELECT {kc}count(*) AS n,
         CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
  FROM {name}_v {gb}
),
{name}_c AS (
  SELECT {kc}CAST(least(floor((x - lo) * ({float(bins)} / (hi - lo))), {bins - 1}) AS INTEGER) AS bin, count(*) AS c
  FROM {name}_v JOIN {name}_r {using} GROUP BY ALL
),
{name}_g AS (SELECT {kc}n, lo, hi, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM {name}_r),
{name} AS (
  SELECT {gkc}g.bin, g.lo + g.bin * ((g.hi - g.lo) / {float(bins)}) AS edge_lo,
         g.lo + (g.bin + 1) * ((g.hi - g.lo) / {float(bins)}) AS edge_hi,
         coalesce(c.c, 0) AS count{dens}
  FROM {name}_g g LEFT JOIN {name}_c c ON {on_c}
)"""


def corr_sql(src: str, cols: list[str], pairs: list[tuple[str, str]], name: str) -> str:
    """CTE ``{name}`` (f1, f2, corr): two-pass Pearson, null when a variance is 0."""
    idx = {c: i for i, c in enumerate(cols)}
    means = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(cols))
    devs = ", ".join(f"CAST({c} AS DOUBLE) - m{i} AS d{i}" for i, c in enumerate(cols))
    sums = ", ".join([f"sum(d{i} * d{i}) AS s{i}" for i in range(len(cols))] +
                     [f"sum(d{idx[a]} * d{idx[b]}) AS c{k}" for k, (a, b) in enumerate(pairs)])
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, CASE WHEN s{idx[a]} * s{idx[b]} = 0 THEN NULL "
        f"ELSE c{k} / sqrt(s{idx[a]} * s{idx[b]}) END AS corr FROM {name}_s"
        for k, (a, b) in enumerate(pairs))
    return f"""
{name}_m AS (SELECT {means} FROM {src}),
{name}_d AS (SELECT {devs} FROM {src}, {name}_m),
{name}_s AS (SELECT {sums} FROM {name}_d),
{name} AS ({rows})"""


def dashboard_sql(step: int = 10) -> str:
    """CTEs after ``windows_sql``: per-window modes (ties -> smallest) and the T4b projection ``dash``."""
    parts = []
    for name, col in [("ms", "source"), ("md", "destination"), ("mp", "dst_port")]:
        parts.append(f"""{name} AS (SELECT w, {col} AS v, count(*) AS c FROM wx WHERE {col} IS NOT NULL GROUP BY w, {col}),
{name}r AS (SELECT w, v FROM (SELECT w, v, row_number() OVER (PARTITION BY w ORDER BY c DESC, v) AS k FROM {name}) WHERE k = 1)""")
    return ",\n".join(parts) + f""",
dash AS (
  SELECT windows.* EXCLUDE (URG_count, dominant_ratio, Label), msr.v AS rep_src_ip, mdr.v AS rep_dst_ip,
         CAST(mpr.v AS VARCHAR) AS rep_dst_port
  FROM windows LEFT JOIN msr ON msr.w * {step} = windows.window_idx LEFT JOIN mdr ON mdr.w * {step} = windows.window_idx
       LEFT JOIN mpr ON mpr.w * {step} = windows.window_idx
)"""
