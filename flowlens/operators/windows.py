"""W3 + G1-G21: sliding count windows (``size`` packets, sliding by ``step``).

A window is a range of packet positions (W0 ranks), so "first/last by position"
becomes min_by/max_by on the rank. Three physical shapes:

* ``chunks`` (default): packets are dealt as plain rows to chunks of some hundred consecutive
  positions, a chunk's last windows bring copies of the next ``size - step`` packets. The sorted
  array of a chunk is sliced into its windows, and array functions give what needs a window's
  values (distinct counts, entropy, modes). Sums, moments and extremes are aggregates of
  fixed-width buffers over the copies, joined by window. No hash aggregate holds lists per window,
  which falls back to sorting after 128 windows.
* ``explode``: each packet is copied to the <= size/step windows that contain
  it, then one ``groupBy(window)``. Rows of a window sit in one rank bucket, so partial
  aggregates combine most copies before the shuffle.
* ``panes``: packets are first aggregated into panes of g = gcd(size, step) consecutive
  positions, whose summaries are copied to the size/g windows containing them. The
  summaries carry lists, so it moves more bytes than ``explode`` at the default size
  and step (53 against 28 MB at sf0.1).

All give the same rows; the later two serve as the first one's test. Nothing is collected per
unbounded group: every list/set held per window or pane has at most ``size`` elements, a chunk at most
``max(CHUNK_ROWS, CHUNK_SIZES * size) + size`` (rounded up to whole steps).
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import STEP_SIZE, WINDOW_SIZE
from flowlens.operators.rank import packet_rank

#: a chunk holds the packets of so many positions, or so many window sizes, if that is more
CHUNK_ROWS, CHUNK_SIZES = 500, 4

FLAG_COLS = ["SYN", "ACK", "FIN", "RST", "PSH", "URG"]


def window_span(r: Column, n: Column, size: int, step: int, unit: int = 1) -> tuple[Column, Column]:
    """Window ordinals [lo, hi] covering positions ``r*unit .. r*unit+unit-1``.

    A window w covers positions [w*step, w*step+size). With unit > 1, ``r`` is a pane id.
    """
    first = r * F.lit(unit)
    last = first + F.lit(unit - 1)
    lo = F.when(last < F.lit(size), F.lit(0)).otherwise(F.floor((last - F.lit(size)) / F.lit(step)) + 1)
    hi = F.least(F.floor(first / F.lit(step)), F.floor((n - F.lit(size)) / F.lit(step)))
    return lo.cast("bigint"), hi.cast("bigint")


def _entropy(protos: Column, n: Column) -> Column:
    """-sum p*log2(p + 1e-9) over the shares of an array's values other than null (<= size elements)."""
    def term(acc, d):
        c = F.when(d.isNull(), 0).otherwise(F.size(protos) - F.size(F.array_remove(protos, d)))
        p = c.cast("double") / n
        return acc + p * F.log2(p + F.lit(1e-9))

    return -F.aggregate(F.array_distinct(protos), F.lit(0.0), term)


def _dominant(labels: Column) -> Column:
    """Most frequent label of an array of (rank, label) structs; tie -> first by rank.

    Returns struct(c, neg_first, label)."""
    distinct = F.array_distinct(F.transform(labels, lambda s: s["label"]))
    stats = F.transform(
        distinct,
        lambda d: F.struct(
            F.size(F.filter(labels, lambda s: s["label"] == d)).alias("c"),
            (-F.array_min(F.transform(F.filter(labels, lambda s: s["label"] == d), lambda s: s["rank"]))).alias("nf"),
            d.alias("label"),
        ),
    )
    return F.array_max(stats)


def _dominant_in_order(labels: Column) -> Column:
    """``_dominant`` of labels that stand in rank order: a tie goes to the label that comes first."""
    stats = F.transform(
        F.array_distinct(labels),
        lambda d: F.struct(
            F.when(d.isNull(), 0).otherwise(F.size(labels) - F.size(F.array_remove(labels, d))).alias("c"),
            (-F.array_position(labels, d)).alias("nf"),
            d.alias("label"),
        ),
    )
    return F.array_max(stats)


def _finish(agg: DataFrame, step: int, has_labels: bool, dashboard: bool, keys: tuple[str, ...] = ()) -> DataFrame:
    """Derived columns, in the reference column order."""
    n = F.col("pkt_count")
    dur = F.greatest(F.col("time_end") - F.col("time_start"), F.lit(1e-9))
    cols = [
        *keys,
        (F.col("w") * F.lit(step)).cast("bigint").alias("window_idx"),
        "time_start", "time_end",
        n.cast("bigint").alias("pkt_count"),
        F.col("byte_total").cast("double").alias("byte_total"),
        F.col("byte_mean").cast("double").alias("byte_mean"),
        F.col("byte_std").cast("double").alias("byte_std"),
        F.col("byte_min").cast("double").alias("byte_min"),
        F.col("byte_max").cast("double").alias("byte_max"),
        (n / dur).alias("pkt_rate"),
        (F.col("byte_total").cast("double") / dur).alias("byte_rate"),
        dur.alias("flow_duration"),
        "IAT_mean", "IAT_std", "IAT_min", "IAT_max", "IAT_total",
        *[F.col(f"{f}_count").cast("bigint").alias(f"{f}_count") for f in FLAG_COLS if not (dashboard and f == "URG")],
        *[(F.col(f"{f}_count") / n).alias(f"{f.lower()}_ratio") for f in FLAG_COLS[:5]],
        F.when((F.col("SYN_count") > 0) & (F.col("ACK_count") == 0), 1).otherwise(0).cast("int").alias("syn_no_ack"),
        "n_unique_src", "n_unique_dst", "n_unique_flows", "n_unique_dports", "n_unique_sports",
        "protocol_entropy",
    ]
    if dashboard:
        return agg.select(*cols, "rep_src_ip", "rep_dst_ip", "rep_dst_port")
    if has_labels:
        cols += [(F.col("_dom")["c"] / n).alias("dominant_ratio"), F.col("_dom")["label"].cast("int").alias("Label")]
    else:
        cols += [F.lit(-1.0).alias("dominant_ratio"), F.lit(-1).alias("Label")]
    return agg.select(*cols)


def _number_aggs() -> list[Column]:
    return [
        F.min_by("time", "rank").alias("time_start"),
        F.max_by("time", "rank").alias("time_end"),
        F.count(F.lit(1)).alias("pkt_count"),
        F.sum("length").alias("byte_total"),
        F.avg("length").alias("byte_mean"),
        F.stddev_pop("length").alias("byte_std"),
        F.min("length").alias("byte_min"),
        F.max("length").alias("byte_max"),
        F.avg("iat").alias("IAT_mean"),
        F.stddev_pop("iat").alias("IAT_std"),
        F.min("iat").alias("IAT_min"),
        F.max("iat").alias("IAT_max"),
        F.sum("iat").alias("IAT_total"),
        *[F.sum(F.col(f"flag_{f}").cast("bigint")).alias(f"{f}_count") for f in FLAG_COLS],
    ]


def _copies(ranked: DataFrame, size: int, step: int, first: str | None) -> DataFrame:
    """Each packet once for every window ``w`` that holds it."""
    lo, hi = window_span(F.col("rank"), F.col("_n"), size, step)
    if first:
        lo = F.greatest(lo, F.col(first).cast("bigint"))
    return ranked.where((F.col("_n") >= size) & (lo <= hi)).withColumn("w", F.explode(F.sequence(lo, hi)))


def _explode_windows(ranked: DataFrame, size: int, step: int, has_labels: bool, dashboard: bool,
                     keys: tuple[str, ...] = (), first: str | None = None) -> DataFrame:
    x = _copies(ranked, size, step, first)
    aggs = [
        *_number_aggs(),
        # size(collect_set) instead of several count(distinct): no Expand, <= size values
        F.size(F.collect_set("source")).cast("bigint").alias("n_unique_src"),
        F.size(F.collect_set("destination")).cast("bigint").alias("n_unique_dst"),
        F.size(F.collect_set("flow_id")).cast("bigint").alias("n_unique_flows"),
        F.size(F.collect_set("dst_port")).cast("bigint").alias("n_unique_dports"),
        F.size(F.collect_set("src_port")).cast("bigint").alias("n_unique_sports"),
        F.collect_list("proto_num").alias("_protos"),
    ]
    if has_labels and not dashboard:
        aggs.append(F.collect_list(F.struct("rank", F.col("label").alias("label"))).alias("_labels"))
    if dashboard:
        aggs += [
            F.mode("source", deterministic=True).alias("rep_src_ip"),
            F.mode("destination", deterministic=True).alias("rep_dst_ip"),
            F.mode("dst_port", deterministic=True).cast("string").alias("rep_dst_port"),
        ]
    g = x.groupBy(*keys, "w").agg(*aggs)
    g = g.withColumn("protocol_entropy", _entropy(F.col("_protos"), F.col("pkt_count").cast("double")))
    if has_labels and not dashboard:
        g = g.withColumn("_dom", _dominant(F.col("_labels")))
    return _finish(g, step, has_labels, dashboard, keys)


def _distinct(values: Column) -> Column:
    """Distinct values other than null (``array_compact`` would be a lambda call per element)."""
    return (F.size(F.array_distinct(F.concat(values, F.array(F.lit(None))))) - 1).cast("bigint")


def _chunk_windows(ranked: DataFrame, size: int, step: int, has_labels: bool, dashboard: bool,
                   keys: tuple[str, ...] = (), first: str | None = None) -> DataFrame:
    per = -(-max(CHUNK_ROWS, CHUNK_SIZES * size) // step)  # windows that start in a chunk
    length = per * step
    at = F.floor(F.col("rank") / F.lit(length)).cast("bigint")
    # a packet is in its own chunk and in the earlier ones whose last windows reach it
    low = F.greatest(F.floor((F.col("rank") - F.lit(size - step)) / F.lit(length)).cast("bigint"), F.lit(0)) if size > step else at
    fields = ["source", "destination", "flow_id", "dst_port", "src_port", "proto_num"] + (["label"] if has_labels and not dashboard else [])
    extra = ["_n"] + ([first] if first else [])
    rows = ranked.where(F.col("_n") >= size).select(
        *keys, *extra, "rank", *fields, F.explode(F.sequence(F.least(low, at), at)).alias("_chunk"))
    # dealt as plain rows: lists are built where they are used, not before the shuffle
    rows = rows.repartition(*keys, "_chunk")
    packed = rows.groupBy(*keys, "_chunk").agg(
        *[F.max(c).alias(c) for c in extra], F.sort_array(F.collect_list(F.struct("rank", *fields))).alias("_rows"))
    lo = F.col("_chunk") * F.lit(per)
    if first:
        lo = F.greatest(lo, F.col(first).cast("bigint"))
    hi = F.least(F.col("_chunk") * F.lit(per) + F.lit(per - 1), F.floor((F.col("_n") - F.lit(size)) / F.lit(step)).cast("bigint"))
    base = F.col("_rows")[0]["rank"]

    def window(w: Column) -> Column:
        begin = w * F.lit(step) - base  # ranks are contiguous from the chunk's first one
        start = F.greatest(begin, F.lit(0))
        return F.struct(w.alias("w"), F.slice("_rows", (start + 1).cast("int"), (begin + F.lit(size) - start).cast("int")).alias("s"))

    wanted = F.filter(F.sequence(lo, hi), lambda w: w * F.lit(step) + F.lit(size) > base)
    x = packed.where(lo <= hi).select(*keys, F.explode(F.transform(wanted, window)).alias("_w"))
    x = x.select(*keys, F.col("_w.w").alias("w"), F.col("_w.s").alias("s")).where(F.size("s") > 0)
    cols = [
        *keys, "w",
        _distinct(F.col("s.source")).alias("n_unique_src"),
        _distinct(F.col("s.destination")).alias("n_unique_dst"),
        _distinct(F.col("s.flow_id")).alias("n_unique_flows"),
        _distinct(F.col("s.dst_port")).alias("n_unique_dports"),
        _distinct(F.col("s.src_port")).alias("n_unique_sports"),
        _entropy(F.col("s.proto_num"), F.size("s").cast("double")).alias("protocol_entropy"),
    ]
    if has_labels and not dashboard:
        cols.append(_dominant_in_order(F.col("s.label")).alias("_dom"))
    if dashboard:
        cols += [_array_mode(F.col("s.source")).alias("rep_src_ip"), _array_mode(F.col("s.destination")).alias("rep_dst_ip"),
                 _array_mode(F.col("s.dst_port")).cast("string").alias("rep_dst_port")]
    # sums, moments and extremes: plain aggregates in a hash table of fixed-width rows, combined before their shuffle
    numbers = _copies(ranked, size, step, first).groupBy(*keys, "w").agg(*_number_aggs())
    return _finish(numbers.join(x.select(*cols), [*keys, "w"]), step, has_labels, dashboard, keys)


def windows_at_positions(placed: DataFrame, size: int, step: int, has_labels: bool, keys: list[str]) -> DataFrame:
    """Windows per ``keys`` of packets whose positions are known: ``rank`` within the key, ``_n`` packets of the
    key so far, and ``_first``, the ordinal of the first window wanted."""
    return _chunk_windows(placed, size, step, has_labels, False, tuple(keys), "_first")


def _pane_windows(ranked: DataFrame, size: int, step: int, has_labels: bool, dashboard: bool) -> DataFrame:
    g = gcd(size, step)
    k = size // g  # panes per window
    pane = F.floor(F.col("rank") / F.lit(g)).cast("bigint")
    # 1) panes: at most g packets each; partial aggregation combines map-side
    pane_aggs = [
        F.first("_n").alias("_n"),
        F.min_by("time", "rank").alias("t_first"),
        F.max_by("time", "rank").alias("t_last"),
        F.count(F.lit(1)).alias("c"),
        F.sum("length").alias("bsum"),
        F.avg("length").alias("bmean"),
        F.var_pop("length").alias("bvar"),
        F.min("length").alias("bmin"),
        F.max("length").alias("bmax"),
        F.sum("iat").alias("isum"),
        F.avg("iat").alias("imean"),
        F.var_pop("iat").alias("ivar"),
        F.min("iat").alias("imin"),
        F.max("iat").alias("imax"),
        *[F.sum(F.col(f"flag_{f}").cast("bigint")).alias(f"{f}_count") for f in FLAG_COLS],
        F.collect_set("source").alias("s_src"),
        F.collect_set("destination").alias("s_dst"),
        F.collect_set("flow_id").alias("s_flow"),
        F.collect_set("dst_port").alias("s_dport"),
        F.collect_set("src_port").alias("s_sport"),
        F.collect_list("proto_num").alias("l_proto"),
    ]
    if has_labels and not dashboard:
        pane_aggs.append(F.collect_list(F.struct("rank", F.col("label").alias("label"))).alias("l_label"))
    if dashboard:
        pane_aggs += [F.collect_list(F.struct("source", "destination", "dst_port")).alias("l_rep")]
    panes = ranked.where(F.col("_n") >= size).groupBy(pane.alias("p")).agg(*pane_aggs)
    lo, hi = window_span(F.col("p"), F.col("_n"), size, step, unit=g)
    # a pane belongs to window w iff w*step <= p*g and p*g + g <= w*step + size
    x = panes.where(lo <= hi).withColumn("w", F.explode(F.sequence(lo, hi)))

    # 2) windows from panes: mean/variance merged exactly from per-pane moments
    n = F.col("pkt_count").cast("double")
    aggs = [
        F.min_by("t_first", "p").alias("time_start"),
        F.max_by("t_last", "p").alias("time_end"),
        F.sum("c").alias("pkt_count"),
        F.sum("bsum").alias("byte_total"),
        F.collect_list(F.struct("c", "bmean", "bvar")).alias("_bm"),
        F.min("bmin").alias("byte_min"),
        F.max("bmax").alias("byte_max"),
        F.sum("isum").alias("IAT_total"),
        F.collect_list(F.struct("c", "imean", "ivar")).alias("_im"),
        F.min("imin").alias("IAT_min"),
        F.max("imax").alias("IAT_max"),
        *[F.sum(f"{f}_count").alias(f"{f}_count") for f in FLAG_COLS],
        F.size(F.array_distinct(F.flatten(F.collect_list("s_src")))).cast("bigint").alias("n_unique_src"),
        F.size(F.array_distinct(F.flatten(F.collect_list("s_dst")))).cast("bigint").alias("n_unique_dst"),
        F.size(F.array_distinct(F.flatten(F.collect_list("s_flow")))).cast("bigint").alias("n_unique_flows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("s_dport")))).cast("bigint").alias("n_unique_dports"),
        F.size(F.array_distinct(F.flatten(F.collect_list("s_sport")))).cast("bigint").alias("n_unique_sports"),
        F.flatten(F.collect_list("l_proto")).alias("_protos"),
    ]
    if has_labels and not dashboard:
        aggs.append(F.flatten(F.collect_list("l_label")).alias("_labels"))
    if dashboard:
        aggs.append(F.flatten(F.collect_list("l_rep")).alias("_rep"))
    wdf = x.groupBy("w").agg(*aggs)

    def pooled(m: Column, mean_f: str, var_f: str, mu: Column) -> Column:
        return F.sqrt(
            F.greatest(
                F.aggregate(m, F.lit(0.0), lambda a, s: a + s["c"] * (s[var_f] + (s[mean_f] - mu) * (s[mean_f] - mu))) / n,
                F.lit(0.0),
            )
        )

    bmu = F.col("byte_total").cast("double") / n
    imu = F.col("IAT_total") / n
    wdf = (
        wdf.withColumn("byte_mean", bmu)
        .withColumn("byte_std", pooled(F.col("_bm"), "bmean", "bvar", bmu))
        .withColumn("IAT_mean", imu)
        .withColumn("IAT_std", pooled(F.col("_im"), "imean", "ivar", imu))
        .withColumn("protocol_entropy", _entropy(F.col("_protos"), n))
    )
    if has_labels and not dashboard:
        wdf = wdf.withColumn("_dom", _dominant(F.col("_labels")))
    if dashboard:
        for name, field, cast in [("rep_src_ip", "source", None), ("rep_dst_ip", "destination", None),
                                  ("rep_dst_port", "dst_port", "string")]:
            vals = F.transform(F.col("_rep"), _field_getter(field))
            c = _array_mode(vals)
            wdf = wdf.withColumn(name, c.cast("string") if cast else c)
    return _finish(wdf, step, has_labels, dashboard)


def _field_getter(name: str):
    return lambda s: s[name]


def _array_mode(vals: Column) -> Column:
    """Most frequent non-null value of an array (<= size elements); ties -> smallest.

    One walk over the sorted values keeps the longest run (``n`` of ``v``) and the current one (``c`` of ``x``): a filter per
    distinct value would be a lambda call for every pair of them."""
    ordered = F.sort_array(F.array_compact(vals))

    def step(acc: Column, x: Column) -> Column:
        c = F.when(acc["x"] == x, acc["c"] + 1).otherwise(1)
        longer = c > acc["n"]
        return F.struct(F.when(longer, c).otherwise(acc["n"]).alias("n"), F.when(longer, x).otherwise(acc["v"]).alias("v"),
                        c.alias("c"), x.alias("x"))

    first = F.get(ordered, F.lit(0))
    zero = F.struct(F.lit(0).alias("n"), first.alias("v"), F.lit(0).alias("c"), first.alias("x"))
    return F.aggregate(ordered, zero, step, lambda acc: acc["v"])


def window_features(
    packets: DataFrame,
    size: int = WINDOW_SIZE,
    step: int = STEP_SIZE,
    order_by: tuple[str, str] | None = None,
    method: str = "chunks",
    dashboard: bool = False,
    num_buckets: int | None = None,
) -> DataFrame:
    """T4: one row per complete window (none when fewer than ``size`` packets).

    ``packets`` is the output of ``packet_features``; ordering is by global_time when
    present (merged timeline) else by capture time, tie-broken by ``no``.
    """
    if order_by is None:
        order_by = ("global_time", "no") if "global_time" in packets.columns else ("time", "no")
    has_labels = "label" in packets.columns
    ranked = packet_rank(packets, order_by=order_by, rank_col="rank", total_col="_n", num_buckets=num_buckets)
    if method == "panes" and gcd(size, step) > 1:
        return _pane_windows(ranked, size, step, has_labels, dashboard)
    if method == "explode":
        return _explode_windows(ranked, size, step, has_labels, dashboard)
    return _chunk_windows(ranked, size, step, has_labels, dashboard)
