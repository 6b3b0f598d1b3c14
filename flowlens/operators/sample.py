"""Sampling (D1, D3, D4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import DOWNSAMPLE_FRAC, DOWNSAMPLE_LABELS, DOWNSAMPLE_MIN_KEEP, RANDOM_SEED
from flowlens.operators.rank import packet_rank


def portable_hash(c: Column | str, seed: int = RANDOM_SEED) -> Column:
    """A sampling order that any SQL engine can state, for checks only: (x*7919 + seed*104729) % 1000003 keeps
    runs of neighbours together."""
    x = F.col(c) if isinstance(c, str) else c
    return ((x * F.lit(7919) + F.lit(seed * 104729)) % F.lit(1000003)).cast("bigint")


def downsample(
    df: DataFrame,
    sample_frac: float = DOWNSAMPLE_FRAC,
    seed: int = RANDOM_SEED,
    min_keep: int = DOWNSAMPLE_MIN_KEEP,
    labels: Sequence[int] | None = DOWNSAMPLE_LABELS,
    label_col: str = "label",
    id_col: str = "no",
    order: Column | None = None,
) -> DataFrame:
    """Exact-size sample without replacement of each listed label:
    ``keep = max(floor(n*frac), min_keep) if n > min_keep else n``; other labels whole.

    Rows are ordered per label by a seeded hash of their capture (when there is one) and id, or by ``order``,
    and the first ``keep`` are kept, using the keyed two-level rank (no single-partition window, no driver loop;
    one plan whatever the counts). ``labels=None`` thins every label; rows without a label are kept.
    """
    listed = F.lit(True) if labels is None else F.coalesce(F.col(label_col).isin(list(labels)), F.lit(False))
    if order is None:
        order = F.xxhash64(*[c for c in ("capture",) if c in df.columns], id_col, F.lit(seed))
    h = df.where(listed).withColumn("_h", order.cast("double"))
    ranked = packet_rank(h, order_by=("_h", id_col), rank_col="_r", keys=[label_col], total_col="_nl")
    n = F.col("_nl")
    keep = F.when(n > min_keep, F.greatest(F.floor(n * F.lit(float(sample_frac))), F.lit(min_keep))).otherwise(n)
    kept = ranked.where(F.col("_r") < keep).drop("_h", "_r", "_nl")
    return df.where(~listed).unionByName(kept)


def sample_series(windows: DataFrame, n: int = 500, seed: int = RANDOM_SEED, order: Column | None = None) -> DataFrame:
    """D3: at most ``n`` windows in seeded-hash order (top-k, no full sort) or by ``order``, by time_start."""
    if order is None:
        order = F.xxhash64("window_idx", F.lit(seed))
    picked = windows.withColumn("_h", order).orderBy("_h", "window_idx").limit(n)
    # at most n rows: the final time sort is small
    return picked.drop("_h").orderBy("time_start", "window_idx")


def bootstrap_class_dist(
    windows: DataFrame, n_boot: int = 200, frac: float = 0.5, seed: int = RANDOM_SEED, label_col: str = "Label"
) -> DataFrame:
    """Class shares in ``n_boot`` resamples of ``floor(frac*n)`` rows drawn with replacement.

    The class counts of one resample are exactly Multinomial(k, class shares), so each
    resample is one multinomial draw from the per-class counts (one aggregate over the
    windows, one row per class) instead of k row draws: O(n) work instead of
    O(n_boot * n). The draws run in Spark tasks (one row per resample); the class
    counts are a bounded table shipped with the task.
    Output: rep, <label>, share (classes absent from a resample are listed with 0).
    """
    import numpy as np
    import pandas as pd

    counts = sorted((r[0], r[1]) for r in windows.groupBy(label_col).agg(F.count(F.lit(1))).collect())
    labels = [c[0] for c in counts]
    n = sum(c[1] for c in counts)
    k = int(n * frac)
    p = np.array([c[1] for c in counts], dtype=float) / max(n, 1)

    def draw(batches):
        for pdf in batches:
            rows = []
            for rep in pdf["id"]:
                rng = np.random.default_rng([seed, int(rep)])
                got = rng.multinomial(k, p) if k > 0 else np.zeros(len(p), dtype=int)
                rows += [(int(rep), lab, float(c) / max(k, 1)) for lab, c in zip(labels, got)]
            yield pd.DataFrame(rows, columns=["rep", label_col, "share"])

    spark = windows.sparkSession
    schema = f"rep bigint, {label_col} int, share double"
    return spark.range(0, n_boot, numPartitions=max(1, min(n_boot, spark.sparkContext.defaultParallelism))).mapInPandas(draw, schema)
