"""Exploratory aggregates (E1-E12) on packets and windows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import FEATURE_COLS
from flowlens.functions.packet import class_name, clip, np_round, time_bin
from flowlens.operators.rank import packet_rank


# ---------------------------------------------------------------------- helpers
def histogram(
    df: DataFrame,
    value: str,
    bins: int | str,
    keys: Sequence[str] = (),
    density: bool = False,
    range_: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width histogram per key group, numpy semantics: range = (min, max) of the
    group (widened by 0.5 each side when min == max), last bin closed. Every bin is
    returned, empty ones with count 0 (keys x bins rows, bounded by ``bins``). ``bins`` is a
    number or the name of a column that is constant within a group."""
    keys = list(keys)
    n_bins = F.max("_bins").alias("_bins")
    vals = df.select(*keys, (F.col(bins) if isinstance(bins, str) else F.lit(bins)).alias("_bins"), F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if range_ is None:
        rng = vals.groupBy(*keys).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"), F.count(F.lit(1)).alias("_n"),
                                     n_bins)
        rng = rng.select(
            *keys, "_n", "_bins",
            F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
            F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"),
        )
    else:
        vals = vals.where((F.col("_x") >= range_[0]) & (F.col("_x") <= range_[1]))
        rng = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), n_bins).select(
            *keys, "_n", "_bins", F.lit(float(range_[0])).alias("_lo"), F.lit(float(range_[1])).alias("_hi"))
    # one row per key group: bounded by the number of groups; AQE broadcasts it when small
    vals = vals.drop("_bins")
    x = vals.join(rng, keys, "inner") if keys else vals.crossJoin(F.broadcast(rng))
    b = F.least(F.floor((F.col("_x") - F.col("_lo")) * (F.col("_bins").cast("double") / (F.col("_hi") - F.col("_lo")))),
                F.col("_bins") - 1).cast("int")
    counts = x.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*keys, "_n", "_lo", "_hi", "_bins", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins").cast("double")
    out = grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin",
        (F.col("_lo") + F.col("bin") * width).alias("edge_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("edge_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        *([(F.coalesce(F.col("count"), F.lit(0)) / (F.col("_n") * width)).alias("density")] if density else []),
    )
    return out


def exact_percentiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), tiebreak: str | None = None
) -> DataFrame:
    """Exact percentiles with linear interpolation (numpy/pandas default), per key group.

    Spark's exact ``percentile`` buffers a whole group in one task; here the values are
    ranked with the keyed two-level rank and only the (at most two) rows around each
    requested position are kept, so no group is ever held in memory.
    Output: keys..., p, value.
    """
    keys = list(keys)
    # ties do not change a percentile value; the tie-break only spreads equal values
    # over buckets, and must be deterministic (a content hash, never a row id)
    tb = F.col(tiebreak) if tiebreak else F.xxhash64(*df.columns)
    base = df.select(*keys, F.col(value).cast("double").alias("_v"), tb.alias("_tb")).where(F.col("_v").isNotNull())
    ranked = packet_rank(base, order_by=("_v", "_tb"), rank_col="_r", keys=keys, total_col="_n")
    ps = F.array(*[F.lit(float(p)) for p in probs])
    at = F.col("_n") - 1
    wanted = F.exists(ps, lambda p: (F.col("_r") == F.floor(p * at)) | (F.col("_r") == F.ceil(p * at)))
    pos = ranked.where(wanted).select(*keys, "_v", "_r", "_n", F.explode(ps).alias("p")).withColumn(
        "_pos", F.col("p") * (F.col("_n") - 1))
    near = pos.where((F.col("_r") == F.floor("_pos")) | (F.col("_r") == F.ceil("_pos")))
    agg = near.groupBy(*keys, "p").agg(
        F.max_by("_v", F.when(F.col("_r") == F.floor("_pos"), 1).otherwise(0)).alias("_lo_v"),
        F.max_by("_v", F.when(F.col("_r") == F.ceil("_pos"), 1).otherwise(0)).alias("_hi_v"),
        F.first("_pos").alias("_pos"),
    )
    frac = F.col("_pos") - F.floor("_pos")
    return agg.select(*keys, "p", (F.col("_lo_v") + frac * (F.col("_hi_v") - F.col("_lo_v"))).alias("value"))


def correlations(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Pearson correlation for column pairs (all pairs i<j by default). Output: f1, f2, corr.

    Pass 1: column means (one-row aggregate, broadcast). Pass 2: Spark ML's Gramian-based
    ``Correlation.corr`` (tree aggregation of BLAS updates) on the centred vectors; centring
    first keeps its one-pass covariance formula as exact as a two-pass one. The result is a
    k x k matrix (bounded by the number of columns). A constant column gives null (pandas:
    NaN), never an ANSI divide-by-zero.
    """
    import math

    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    cols = list(cols)
    pairs = list(pairs) if pairs is not None else list(combinations(cols, 2))
    idx = {c: i for i, c in enumerate(cols)}
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    means = x.agg(*[F.avg(c).alias(f"_m_{i}") for i, c in enumerate(cols)])
    centred = x.crossJoin(F.broadcast(means)).select(
        array_to_vector(F.array(*[(F.col(c) - F.col(f"_m_{i}")) for i, c in enumerate(cols)])).alias("_v"))
    mat = Correlation.corr(centred, "_v").first()[0].toArray()
    rows = []
    for a, b in pairs:
        v = float(mat[idx[a], idx[b]])
        rows.append((a, b, None if math.isnan(v) else v))
    return df.sparkSession.createDataFrame(rows, "f1 string, f2 string, corr double")


# ---------------------------------------------------------------------- packets
def class_counts(packets: DataFrame, label: str = "label") -> DataFrame:
    """Packets per class."""
    return packets.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("class_name", class_name(label))


def packet_rate(packets: DataFrame, label: str = "label", t: str = "global_time") -> DataFrame:
    """Packets per (class, whole second)."""
    return packets.groupBy(label, time_bin(t).alias("second")).agg(F.count(F.lit(1)).alias("packets"))


def length_hist(packets: DataFrame, bins: int = 50, label: str = "label") -> DataFrame:
    """Density histogram of packet length per class."""
    return histogram(packets, "length", bins, [label], density=True)


def protocol_top10(packets: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent protocols (top-k: TakeOrderedAndProject, no full sort)."""
    c = packets.groupBy("protocol").agg(F.count(F.lit(1)).alias("count"))
    return c.orderBy(F.desc("count"), F.asc_nulls_last("protocol")).limit(k)


def unique_src_per_s(packets: DataFrame, t: str = "global_time") -> DataFrame:
    """E5: distinct sources per whole second."""
    return packets.groupBy(time_bin(t).alias("second")).agg(F.count_distinct("source").alias("n_src"))


def iat_raw_hist(packets_with_gap: DataFrame, bins: int = 60, label: str = "label") -> DataFrame:
    """Histogram of W2 gaps (clipped 0..0.1) per class."""
    return histogram(packets_with_gap, "iat_raw", bins, [label], density=True)


# ---------------------------------------------------------------------- windows
# FIXED VALUES: per-class window histograms: feature, bins, upper clip.
FEATURE_HISTS = [("syn_ratio", 40, None), ("n_unique_dports", 30, None), ("IAT_min", 40, 0.01)]
KEY_FEATURES = ["syn_ratio", "pkt_rate", "IAT_min", "n_unique_dports", "n_unique_src", "rst_ratio", "ack_ratio", "Label"]
DESCRIBE_FEATURES = ["pkt_count", "byte_total", "byte_mean", "byte_std", "pkt_rate", "SYN_count", "ACK_count",
                     "FIN_count", "RST_count", "n_unique_dports", "IAT_mean"]


def feature_hists(windows: DataFrame, spec=FEATURE_HISTS, label: str = "Label") -> DataFrame:
    """Density histograms of several window features per class, in one pass: the
    features are melted to (feature, value) rows and histogrammed per (feature, class)."""
    parts = [
        F.struct(F.lit(f).alias("feature"), clip(F.col(f).cast("double"), 0.0 if hi is not None else None, hi).alias("v"),
                 F.lit(b).alias("bins"))
        for f, b, hi in spec
    ]
    melted = windows.select(label, F.explode(F.array(*parts)).alias("m")).select(label, "m.feature", "m.v", "m.bins")
    return histogram(melted, "v", "bins", ["feature", label], density=True)


def pkt_rate_box(windows: DataFrame, label: str = "Label", hi: float = 5000.0) -> DataFrame:
    """Box-plot numbers of pkt_rate clipped to [0, 5000] per class: quartiles
    (linear interpolation) and whiskers = extreme values within 1.5 IQR."""
    x = windows.select(label, "window_idx", clip(F.col("pkt_rate"), 0.0, hi).alias("v"))
    q = exact_percentiles(x, "v", [0.25, 0.5, 0.75], [label], tiebreak="window_idx")
    qw = q.groupBy(label).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"),
    )
    j = x.join(qw, label)
    iqr = F.col("q3") - F.col("q1")
    return j.groupBy(label, "q1", "median", "q3").agg(
        F.min(F.when(F.col("v") >= F.col("q1") - 1.5 * iqr, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= F.col("q3") + 1.5 * iqr, F.col("v"))).alias("whisker_hi"),
        F.count(F.lit(1)).alias("n"),
    )


def key_corr(windows: DataFrame) -> DataFrame:
    """Pearson correlation of the key features (all ordered pairs, diagonal 1)."""
    c = correlations(windows, KEY_FEATURES)
    diag = windows.sparkSession.createDataFrame([(f, f, 1.0) for f in KEY_FEATURES], "f1 string, f2 string, corr double")
    sym = c.select(F.col("f2").alias("f1"), F.col("f1").alias("f2"), "corr")
    return c.unionByName(sym).unionByName(diag)


def full_corr(windows: DataFrame) -> DataFrame:
    """Lower triangle (i > j) of the correlation matrix of the 31 features + Label."""
    cols = FEATURE_COLS + ["Label"]
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    return correlations(windows, cols, pairs)


def label_leakage(windows: DataFrame, k: int = 10, threshold: float = 0.85) -> DataFrame:
    """|corr(feature, Label)| descending, top k, with the leakage flag."""
    c = correlations(windows, FEATURE_COLS + ["Label"], [(f, "Label") for f in FEATURE_COLS])
    a = c.select(F.col("f1").alias("feature"), F.abs("corr").alias("abs_corr"))
    top = a.orderBy(F.desc_nulls_last("abs_corr"), "feature").limit(k)
    return top.withColumn("suspect", F.col("abs_corr") > F.lit(threshold))


def describe_by_class(windows: DataFrame, feats=DESCRIBE_FEATURES, label: str = "Label") -> DataFrame:
    """Mean, sample std, min, max (3 decimals, numpy rounding) of key features per class."""
    melted = windows.select(
        label, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in feats]))
        .alias("m")).select(label, "m.feature", "m.v")
    g = melted.groupBy(label, "feature").agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.count(F.lit(1)).alias("n"),
    )
    # pandas .round(3): numpy rounding
    return g.select(label, "feature", *[np_round(c, 3).alias(c) for c in ("mean", "std", "min", "max")], "n")
