"""Operator 7: embedding near-duplicates by Euclidean p-stable hashing (Datar et al., 2004).

Vectors are normalised in double precision, so a cosine of at least c is a distance of at most
sqrt(2 - 2c). A table's key joins K values floor((a.v + b) / w) with Gaussian a; there are L tables.
Rows of equal vectors are one class. Buckets of two and more classes are cut into blocks of
about BLOCK classes and each pair of blocks is compared by one matrix product of exact cosines.
A pair that meets in several tables counts in the first one only (both keys of the earlier tables
are computed again for the pairs that pass), so nothing is gathered to make links distinct, and a
block gives out per-class link counts and a spanning forest, never its pairs.

With w = 2, K = 24, L = 64 a pair at cosine 0.95 is found with probability 0.92, at 0.98 with more
than 0.9999; unrelated vectors share a bucket with probability 3e-8 a table.

Defined results: null vectors, zero vectors and those with null or non-finite components link
with nothing (n_links 0, own component); vectors of different length never link; every row counts
as a vector, also one that repeats a vec_id; an empty table gives an empty result; other columns
are not read. A null vec_id never names a component unless all its members are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import connected_components, cut
from flowlens.llm.partenum import _forest

K, L, WIDTH, SEED = 24, 64, 2.0, 7
BLOCK = 256
SMALL = 24

_PROJ: dict = {}


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows normalised in double precision, short ones filled with zeros; and their lengths."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offs = np.asarray(vectors.offsets)
    flat = np.asarray(vectors.values.cast(pa.float64()))
    dims = np.diff(offs)
    top = int(dims.max(initial=1))
    m = np.zeros((len(dims), top))
    at = np.arange(len(flat[offs[0] : offs[-1]])) - np.repeat(offs[:-1] - offs[0], dims)
    m[np.repeat(np.arange(len(dims)), dims), at] = flat[offs[0] : offs[-1]]
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return m / np.linalg.norm(m, axis=1, keepdims=True), dims


def bucket_keys(m: np.ndarray, dims: np.ndarray, k: int = K, tables: int = L, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """[rows, tables] 64-bit keys."""
    top = max(64, m.shape[1])
    name = (top, k, tables, seed)
    if name not in _PROJ:
        rng = np.random.default_rng(seed)
        b = rng.random(k * tables)
        _PROJ[name] = (np.random.default_rng([seed, 1]).standard_normal((top, k * tables)), b)
    a, b = _PROJ[name]
    q = np.floor(m @ a[: m.shape[1]] / width + b).astype(np.int64).view(np.uint64).reshape(len(m), tables, k)
    with np.errstate(over="ignore"):
        c = tb.seeded(500, k)
        h = np.zeros((len(m), tables), dtype=np.uint64)
        for j in range(k):
            h += tb.splitmix(q[:, :, j] + c[j]) * (c[j] | np.uint64(1))
        return tb.splitmix(h + np.arange(tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + dims.astype(np.uint64)[:, None])


def _buckets(k, tables, width):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                m, dims = _matrix(part.column("v"))
                keys = bucket_keys(m, dims, k, tables, width)
                n = len(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)),
                     pa.array(np.repeat(np.asarray(part.column("cls")), tables))], names=["bucket", "t", "cls"])

    return run


def _compare(cosine: float, k, tables, width):
    """Rows sorted by (bucket, i, j) -> link weights (cls, null, w) and forest links (a, b, null)."""

    def groups(t: pa.Table) -> pa.RecordBatch:
        bucket, i, j, block, table = (np.asarray(t[c].combine_chunks()) for c in ("bucket", "i", "j", "block", "t"))
        cls, weight = np.asarray(t["cls"].combine_chunks()), np.asarray(t["w"].combine_chunks())
        m, dims = _matrix(t["v"])
        first = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        length = np.diff(np.r_[first, len(bucket)])
        run = np.repeat(np.arange(len(first)), length)
        xs, ys = [], []
        small = length[run] <= SMALL
        for gap in range(1, SMALL):
            p = np.flatnonzero((run[gap:] == run[:-gap]) & small[gap:]) if gap < len(run) else np.zeros(0, np.int64)
            for lo in range(0, len(p), 50_000):
                q = p[lo : lo + 50_000]
                hit = q[np.einsum("ij,ij->i", m[q], m[q + gap]) >= cosine]
                xs.append(hit)
                ys.append(hit + gap)
        for f, n in zip(first[length > SMALL], length[length > SMALL]):
            x, y = np.nonzero(np.triu(m[f : f + n] @ m[f : f + n].T >= cosine, 1))
            xs.append(x + f)
            ys.append(y + f)
        x, y = np.concatenate(xs), np.concatenate(ys)
        ok = (i[x] == j[x]) | (block[x] != block[y])
        x, y = x[ok], y[ok]
        keep = np.ones(len(x), dtype=bool)
        if len(x):
            rows = np.unique(np.r_[x, y])
            keys = np.concatenate([bucket_keys(m[rows[lo : lo + 1024]], dims[rows[lo : lo + 1024]], k, tables, width) for lo in range(0, len(rows), 1024)])
            a, c = np.searchsorted(rows, x), np.searchsorted(rows, y)
            for lo in range(0, len(x), 50_000):
                s = slice(lo, lo + 50_000)
                same = keys[a[s]] == keys[c[s]]
                keep[s] = same.argmax(axis=1) == table[x[s]]
        x, y = x[keep], y[keep]
        ids, num = np.unique(cls, return_inverse=True)
        total = np.bincount(np.r_[num[x], num[y]], weights=np.r_[weight[y], weight[x]], minlength=len(ids)).astype(np.int64)
        edge = _forest(num[x], num[y])
        some = np.flatnonzero(total)
        nulls = pa.nulls
        return pa.RecordBatch.from_arrays(
            [pa.array(np.r_[ids[some], cls[x[edge]]]), pa.concat_arrays([nulls(len(some), pa.int64()), pa.array(cls[y[edge]])]),
             pa.concat_arrays([pa.array(total[some]), nulls(len(edge), pa.int64())])], names=["a", "b", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                t = pa.Table.from_batches([b.slice(lo, 4096)])
                t = t if rest is None else pa.concat_tables([rest, t])
                key = np.stack([np.asarray(t[c].combine_chunks()) for c in ("bucket", "i", "j")])
                open_at = np.flatnonzero((key != key[:, -1:]).any(axis=0))
                done = int(open_at[-1]) + 1 if len(open_at) else 0
                if done:
                    yield groups(t.slice(0, done))
                rest = t.slice(done)
        if rest is not None and rest.num_rows:
            yield groups(rest)

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, k: int = K, tables: int = L, width: float = WIDTH,
                 id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col("v")
    size = F.when(v.isNull(), 0).otherwise(F.size(v))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = (size > 0) & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = cut(rows.withColumn("cls", F.when(good, F.xxhash64(F.col("v")))).withColumn("v", F.when(F.col("cls").isNotNull(), v)))
    reps = cut(rows.where("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("w"), F.first("v").alias("v"), F.min("vec_id").alias("least")))
    b = reps.select("cls", "v").mapInArrow(_buckets(k, tables, width), "bucket bigint, t int, cls bigint")
    size = cut(b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = cut(b.join(size, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).drop("n"))
    met = met.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "t", "cls")
    full = met.join(reps.select("cls", "w", "v"), "cls")
    found = cut(
        full.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        .mapInArrow(_compare(cosine, k, tables, width), "a bigint, b bigint, w bigint")
    )
    count = cut(found.where("w is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("w").alias("links")))
    comp = connected_components(found.where("w is null").select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = cut(reps.select("cls", "w", "least").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                .join(count, "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    least = cut(named.groupBy("component").agg(F.min("least").alias("root")))
    info = cut(named.join(least, "component").select(
        "cls", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "root"))
    # rows without a class would all carry one null key: give each a key of its own that matches none
    keyed = rows.select("vec_id", "cls")
    out = keyed.where("cls is not null").join(info, "cls").select("vec_id", F.col("links").alias("n_links"), F.col("root").alias("component_id"))
    alone = keyed.where("cls is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
