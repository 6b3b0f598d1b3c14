"""M5: random forest whose trees are grown and kept by the tasks, never by the driver.

Spark's own forest holds all nodes of all trees on the driver and runs a pass over the rows for every few thousand open nodes. Its
trees grow until their leaves are pure, so nodes come with the rows. Here the same forest (bootstrap, weighted Gini gain, 32 bins
a feature, a fresh subset of the features at every node, sibling leaves of one prediction merged, votes of normalised leaves) is
grown by tasks:

* Features are binned once. Thresholds follow Spark's rule on weighted value summaries of all rows (mergeable, ``SKETCH`` points).
* Up to ``TREE_ROWS`` rows go to every task of a group of trees, which grows them level by level on arrays.
* More rows split the nodes of more than ``TREE_ROWS`` rows first, a job per level: tasks add up histograms of these nodes, which
  are summed and searched where they meet. Then each subtree's own rows go to one task, which grows it.

The driver gets the splits of these top nodes (about trees x rows / TREE_ROWS) and the importances of every subtree. Subtrees are
written to the shared folder and stay there: scoring tasks read them one at a time. Draws go by blocks of rows and by node.

Defined results: NaN goes right; of equal gains the first drawn feature and its least cut win; labels below 0 or none raise a
ValueError. Up to ``SPARK_ROWS`` rows Spark's forest is fitted: small, and its draws stand.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import materialize, shared_path

#: up to so many rows Spark's forest is fitted
SPARK_ROWS = 2_000
#: rows of a subtree that one task grows
TREE_ROWS = 1 << 19
#: points of a feature's value summary
SKETCH = 2_048
#: rows that a scoring task takes through all trees at a time
SCORE_ROWS = 1 << 17
#: gains up to this count as none
LEAST_GAIN = 1e-9

BLOCK_SCHEMA = "block long, bins binary, y binary, weight binary"
UNIT_SCHEMA = "tree int, root int, feature binary, cut binary, next binary, leaf binary"


# ---------------------------------------------------------------- thresholds
def _merged(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; beyond SKETCH values, neighbours of like rank are one."""
    v, at = np.unique(values, return_inverse=True)
    w = np.bincount(at, weights, len(v))
    if len(v) > SKETCH:
        part = np.minimum((np.cumsum(w) / w.sum() * SKETCH).astype(np.int64), SKETCH - 1)
        last = np.flatnonzero(np.append(part[1:] != part[:-1], True))
        v, w = v[last], np.bincount(np.searchsorted(last, np.arange(len(w))), w, len(last))
    return v, w


def _summaries(d: int):
    """mapInArrow body: a value summary per feature of a task's rows."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.empty(0), np.empty(0))] * d
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(b.num_rows, d)
            w = b.column("weight").to_numpy()
            for i in range(d):
                ok = np.isfinite(x[:, i])
                kept[i] = _merged(np.append(kept[i][0], x[ok, i]), np.append(kept[i][1], w[ok]))
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), *(pa.array([k[j].tobytes() for k in kept], pa.binary())
                                                                             for j in (0, 1))], names=["f", "v", "w"])

    return body


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Spark's rule: midpoints of all values if they fit, else those closest to equal shares of the weight."""
    mid = (values[1:] + values[:-1]) / 2
    if len(mid) <= bins - 1:
        return mid
    stride, out = weights.sum() / bins, []
    target, now = stride, weights[0]
    for i in range(1, len(values)):
        before, now = now, now + weights[i]
        if abs(before - target) < abs(now - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out[: bins - 1])


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of thresholds below each value (NaN: all)."""
    out = np.empty(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], side="left")
    return out


def _blocks(edges: list[np.ndarray]):
    """mapInArrow body: a numbered block for every batch of rows, features as bins."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy().reshape(b.num_rows, len(edges))
            data = (binned(x, edges), b.column("label").to_numpy().astype(np.int32), b.column("weight").to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())] + [pa.array([v.tobytes()], pa.binary()) for v in data],
                                             names=["block", "bins", "y", "weight"])
            number += 1

    return body


def _arrays(row, d: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    return row[0], np.frombuffer(row[1], np.uint8).reshape(-1, d), np.frombuffer(row[2], np.int32), np.frombuffer(row[3])


# ---------------------------------------------------------------- growing
@dataclass
class Tree:
    """Nodes in order of depth: ``feature`` -1 at leaves; bins up to ``cut`` go to node ``next``, others to the one after it; at a
    leaf ``next`` is its row of ``leaf`` (shares of the classes)."""

    feature: np.ndarray
    cut: np.ndarray
    next: np.ndarray
    leaf: np.ndarray
    gains: np.ndarray = field(default_factory=lambda: np.empty(0))

    def votes(self, bins: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
        while len(rows):
            f = self.feature[node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            at = node[rows]
            node[rows] = self.next[at] + (bins[rows, f] > self.cut[at])
        return self.leaf[self.next[node]]


def _subsets(rng: np.random.Generator, nodes: int, d: int, m: int) -> np.ndarray:
    """m different features for every node (all of them: in their order)."""
    return np.tile(np.arange(d), (nodes, 1)) if m >= d else np.argpartition(rng.random((nodes, d)), m, axis=1)[:, :m]


def _squares(s: np.ndarray) -> np.ndarray:
    """Sum of squares over the sum: the weight less its Gini impurity."""
    return (s * s).sum(axis=1) / s.sum(axis=1)


def _best(node: np.ndarray, bin_: np.ndarray, y: np.ndarray, w: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best score (-inf: none) and cut of one feature for every node. The bins that occur in a node are found by one sort."""
    shift = max(len(node) - 1, 1).bit_length()
    key = ((node * 256 + bin_) << shift) | np.arange(len(node))
    key.sort()
    at, key = key & ((1 << shift) - 1), key >> shift
    new = np.append(True, key[1:] != key[:-1])
    cell = np.cumsum(new) - 1
    key = key[new]
    k = total.shape[1]
    of, cut = key >> 8, key & 255
    sums = np.cumsum(np.bincount(cell * k + y[at], w[at], len(key) * k).reshape(-1, k), axis=0)
    start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))  # every node has rows
    before = np.vstack([np.zeros(k), sums])[start]
    inner = np.flatnonzero(np.append(of[1:] == of[:-1], False))
    left = sums[inner] - before[of[inner]]
    score = np.full(len(key), -np.inf)
    score[inner] = _squares(left) + _squares(total[of[inner]] - left)
    best = np.maximum.reduceat(score, start)
    hit = np.flatnonzero(score == best[of])[::-1]
    out = np.zeros(len(total), np.uint8)
    out[of[hit]] = cut[hit]  # the first of equals is written last
    return best, out


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, m: int, depth: int, rng: np.random.Generator) -> Tree:
    """A tree on rows of positive weight, at most ``depth`` splits deep."""
    d, node = bins.shape[1], np.zeros(len(bins), np.int64)
    width, after, levels = 1, 1, []
    for level in range(depth + 1):
        total = np.bincount(node * classes + y, w, width * classes).reshape(width, classes)
        feature, cut, gain = np.full(width, -1, np.int16), np.zeros(width, np.uint8), np.zeros(width)
        nxt = np.zeros(width, np.int32)
        levels.append((feature, cut, nxt, total, gain))
        open_ = np.flatnonzero((total > 0).sum(axis=1) > 1) if level < depth else np.empty(0, np.int64)
        if not len(open_):
            break
        slot = np.full(width, -1)
        slot[open_] = np.arange(len(open_))
        keep = slot[node] >= 0
        bins, y, w, node = bins[keep], y[keep], w[keep], slot[node[keep]]
        subset, mine = _subsets(rng, len(open_), d, m), total[open_]
        best, best_cut, best_feature = np.full(len(open_), -np.inf), np.zeros(len(open_), np.uint8), np.zeros(len(open_), np.int16)
        rows = np.arange(len(node))
        for j in range(subset.shape[1]):
            score, c = _best(node, bins[rows, subset[node, j]], y, w, mine)
            better = score > best
            best[better], best_cut[better], best_feature[better] = score[better], c[better], subset[better, j]
        won = best - _squares(mine)
        split = won > LEAST_GAIN * mine.sum(axis=1)
        at = open_[split]
        feature[at], cut[at], gain[at] = best_feature[split], best_cut[split], won[split]
        nxt[at] = after + 2 * np.arange(len(at))
        slot = np.full(len(open_), -1)
        slot[split] = np.arange(len(at))
        keep = slot[node] >= 0
        bins, y, w, node = bins[keep], y[keep], w[keep], node[keep]
        right = bins[np.arange(len(node)), best_feature[node]] > best_cut[node]
        node, width, after = 2 * slot[node] + right, 2 * len(at), after + 2 * len(at)
        if not len(at):
            break
    return _pruned(levels, d)


def _pruned(levels: list[tuple], d: int) -> Tree:
    """Levels as a tree, leaves with the same parent and prediction merged from the deepest up."""
    feature, cut, nxt, total, gain = (np.concatenate(p) for p in zip(*levels))
    first = np.concatenate([[0], np.cumsum([len(v[0]) for v in levels])])
    said = total.argmax(axis=1)
    for a, b in zip(first[-2::-1], first[:0:-1]):
        inner = a + np.flatnonzero(feature[a:b] >= 0)
        one = nxt[inner]
        merge = (feature[one] < 0) & (feature[one + 1] < 0) & (said[one] == said[one + 1])
        feature[inner[merge]] = -1
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for a, b in zip(first[:-1], first[1:]):
        inner = a + np.flatnonzero((feature[a:b] >= 0) & kept[a:b])
        kept[nxt[inner]] = kept[nxt[inner] + 1] = True
    number = np.cumsum(kept) - 1
    leaf = kept & (feature < 0)
    gains = np.bincount(feature[kept & ~leaf], gain[kept & ~leaf], d)
    nxt[kept & ~leaf] = number[nxt[kept & ~leaf]]
    nxt[leaf] = np.arange(leaf.sum())
    shares = total[leaf] / total[leaf].sum(axis=1, keepdims=True)
    return Tree(feature[kept], cut[kept], nxt[kept], shares.astype(np.float32), gains)


def _drawn(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often a tree takes each row of a block."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, rows)


def _unit(tree: int, root: int, t: Tree) -> tuple:
    return tree, root, *(bytearray(v.tobytes()) for v in (t.feature, t.cut, t.next, t.leaf)), bytearray(t.gains.tobytes())


def _whole_trees(seed: int, trees: int, groups: int, d: int, classes: int, m: int, depth: int):
    """mapPartitionsWithIndex body: grows the trees of one group on all rows."""

    def body(group: int, rows: Iterator) -> Iterator[tuple]:
        got = sorted((_arrays(row, d) for _, row in rows), key=lambda r: r[0])
        bins, y, w = (np.concatenate([r[i] for r in got]) for i in (1, 2, 3))
        sizes = [(r[0], len(r[2])) for r in got]
        del got
        for tree in range(group, trees, groups):
            n = np.concatenate([_drawn(seed, tree, b, rows) for b, rows in sizes])
            in_ = np.flatnonzero((n > 0) & (w > 0))
            yield _unit(tree, 0, grow(bins[in_], y[in_], (w * n)[in_], classes, m, depth, np.random.default_rng([seed, tree])))

    return body


# ---------------------------------------------------------------- nodes of many rows
@dataclass
class Top:
    """The part of a tree above its subtrees; nodes as in ``Tree``, in order of making."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    next: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])

    def at(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, nxt = np.array(self.feature), np.array(self.cut), np.array(self.next)
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            f = feature[node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            node[rows] = nxt[node[rows]] + (bins[rows, f] > cut[node[rows]])
        return node


def _histograms(seed: int, tops: list[Top], live: dict[int, dict[int, np.ndarray]], d: int, classes: int, n_bins: int):
    """mapPartitions body: ((tree, node), weight by drawn feature, bin and class, and rows in the last place) of live nodes."""

    def body(rows: Iterator) -> Iterator[tuple]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for row in rows:
            block, bins, y, w = _arrays(row, d)
            for tree, nodes in live.items():
                n = _drawn(seed, tree, block, len(y))
                node = np.where((n > 0) & (w > 0), tops[tree].at(bins), -1)
                for i, subset in nodes.items():
                    in_ = np.flatnonzero(node == i)
                    got = np.zeros((len(subset), n_bins, classes + 1))
                    for j, f in enumerate(subset):
                        b = bins[in_, f].astype(np.int64)
                        got[j, :, :classes] = np.bincount(b * classes + y[in_], (w * n)[in_], n_bins * classes).reshape(n_bins, -1)
                        got[j, :, classes] = np.bincount(b, minlength=n_bins)
                    sums[tree, i] = sums[tree, i] + got if (tree, i) in sums else got
        yield from sums.items()

    return body


def _top_split(h: np.ndarray) -> tuple[int, int, float, list[int]] | None:
    """Drawn place of the feature, cut, gain, and the rows and classes of both sides; None without a gain."""
    left = np.cumsum(h, axis=1)
    right = left[:, -1:] - left
    ok = (left[:, :, -1] > 0) & (right[:, :, -1] > 0)
    score = np.full(ok.shape, -np.inf)
    score[ok] = _squares(left[ok][:, :-1]) + _squares(right[ok][:, :-1])
    whole = left[0, -1, :-1][None]
    j, cut = divmod(int(score.argmax()), h.shape[1])
    gain = float(score[j, cut] - _squares(whole)[0])
    if not gain > LEAST_GAIN * whole.sum():
        return None
    return j, cut, gain, [int(left[j, cut, -1]), int(right[j, cut, -1])]


def _tops(blocks: RDD, seed: int, trees: int, rows: int, d: int, classes: int, m: int, depth: int, n_bins: int, gains: np.ndarray) -> list[Top]:
    """Splits all nodes of more than TREE_ROWS rows, a job per level."""
    tops = [Top() for _ in range(trees)]
    big = {t: [0] for t in range(trees)}
    while big:
        live = {t: {i: _subsets(np.random.default_rng([seed, t, i, 1]), 1, d, m)[0] for i in nodes} for t, nodes in big.items()}
        got = blocks.mapPartitions(_histograms(seed, tops, live, d, classes, n_bins)).reduceByKey(np.add).mapValues(_top_split).collectAsMap()
        big = {}
        for (t, i), split in sorted(got.items()):
            if split is None:
                continue
            j, cut, gain, sides = split
            top, f = tops[t], int(live[t][i][j])
            top.feature[i], top.cut[i], top.next[i] = f, cut, len(top.feature)
            gains[t, f] += gain
            for n in sides:
                if n > TREE_ROWS and top.depth[i] + 1 < depth:
                    big.setdefault(t, []).append(len(top.feature))
                top.feature.append(-1), top.cut.append(0), top.next.append(0), top.depth.append(top.depth[i] + 1)
    return tops


def _dealt(seed: int, tops: list[Top], first: list[int], d: int):
    """flatMap body: a block's drawn rows, dealt to the subtrees below the tops (numbered from ``first`` of their tree)."""

    def body(row) -> Iterator[tuple]:
        block, bins, y, w = _arrays(row, d)
        for tree, top in enumerate(tops):
            n = _drawn(seed, tree, block, len(y))
            in_ = np.flatnonzero((n > 0) & (w > 0))
            node = top.at(bins[in_])
            for i in np.unique(node):
                r = in_[node == i]
                yield first[tree] + int(i), (tree, int(i), block, bins[r].tobytes(), y[r].tobytes(), (w * n)[r].tobytes())

    return body


def _subtrees(seed: int, tops: list[Top], d: int, classes: int, m: int, depth: int):
    """mapPartitions body: grows each subtree on its rows."""

    def body(rows: Iterator) -> Iterator[tuple]:
        units: dict[tuple[int, int], list] = {}
        for _, (tree, i, *row) in rows:
            units.setdefault((tree, i), []).append(_arrays(row, d))
        for tree, i in sorted(units):
            got = sorted(units.pop((tree, i)), key=lambda r: r[0])
            bins, y, w = (np.concatenate([r[j] for r in got]) for j in (1, 2, 3))
            yield _unit(tree, i, grow(bins, y, w, classes, m, depth - tops[tree].depth[i], np.random.default_rng([seed, tree, i])))

    return body


# ---------------------------------------------------------------- model
def _units(path: str, classes: int) -> Iterator[tuple[int, int, Tree]]:
    """The subtrees under a shared folder, one at a time."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    data = ds.dataset(at, filesystem=system, format="parquet")
    for b in data.to_batches(batch_size=1, batch_readahead=1, fragment_readahead=1, use_threads=False):
        for r in b.to_pylist():
            yield r["tree"], r["root"], Tree(np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8),
                                             np.frombuffer(r["next"], np.int32), np.frombuffer(r["leaf"], np.float32).reshape(-1, classes))


@dataclass
class ForestModel:
    """Written subtrees, their tops and the thresholds; ``transform`` adds ``probability``, an array over ``classes`` classes."""

    path: str
    trees: int
    classes: int
    features: str
    edges: list[np.ndarray]
    tops: list[Top] | None
    gains: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        path, trees, classes, edges, tops = f"{self.path}/units", self.trees, self.classes, self.edges, self.tops

        def scored(bins: np.ndarray) -> np.ndarray:
            out, place, of = np.zeros((len(bins), classes)), None, -1
            for tree, root, t in _units(path, classes):
                if tops is None:
                    out += t.votes(bins)
                    continue
                if tree != of:
                    place, of = tops[tree].at(bins), tree
                rows = np.flatnonzero(place == root)
                out[rows] += t.votes(bins[rows])
            return out / trees

        @F.pandas_udf("array<double>")
        def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            def flush(kept: list[np.ndarray]) -> Iterator[pd.Series]:
                got = scored(np.concatenate(kept))
                for size in (len(k) for k in kept):
                    yield pd.Series(list(got[:size]), dtype=object)
                    got = got[size:]

            kept: list[np.ndarray] = []
            for x in parts:
                kept.append(binned(np.stack(x.to_list()), edges) if len(x) else np.empty((0, len(edges)), np.uint8))
                if sum(len(k) for k in kept) >= SCORE_ROWS:
                    yield from flush(kept)
                    kept = []
            if kept:
                yield from flush(kept)

        return df.withColumn("probability", probability(vector_to_array(self.features)))

    def importances(self) -> list[float]:
        """Mean over the trees of a feature's share of the gains."""
        return self.gains

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.read.parquet(f"{self.path}/units").write.mode("overwrite").parquet(f"{path}/units")
        meta = {"trees": self.trees, "classes": self.classes, "features": self.features, "gains": self.gains,
                "edges": [list(map(float, e)) for e in self.edges],
                "tops": None if self.tops is None else [vars(t) for t in self.tops]}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @staticmethod
    def load(path: str) -> ForestModel:
        m = json.loads(SparkSession.active().read.text(f"{path}/model").first()[0])
        return ForestModel(path, m["trees"], m["classes"], m["features"], [np.array(e, float) for e in m["edges"]],
                           None if m["tops"] is None else [Top(**t) for t in m["tops"]], m["gains"])


def subset_size(strategy: str, d: int, trees: int) -> int:
    named = {"auto": math.ceil(math.sqrt(d)) if trees > 1 else d, "all": d, "sqrt": math.ceil(math.sqrt(d)),
             "log2": max(1, math.ceil(math.log2(d))), "onethird": math.ceil(d / 3)}
    if strategy not in named:
        raise ValueError(f"unknown feature subset {strategy!r}")
    return named[strategy]


class ForestClassifier(RandomForestClassifier):
    """Spark's estimator and parameters; more than SPARK_ROWS rows are fitted by the tasks here (``ForestModel``)."""

    def fit(self, dataset: DataFrame, params: dict | None = None):
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("label"),
                              F.col(self.getWeightCol()).cast("double").alias("weight"))
        n, low, high, some = rows.agg(F.count(F.lit(1)), F.min("label"), F.max("label"), F.count("label")).first()
        if params or n <= SPARK_ROWS:
            return super().fit(dataset, params)
        if low is None or low < 0 or some < n:
            raise ValueError("labels must be numbers from 0 on")
        spark, sc = dataset.sparkSession, dataset.sparkSession.sparkContext
        d, classes, trees = rows.select(F.size("x")).first()[0], high + 1, self.getNumTrees()
        depth, seed, n_bins = self.getMaxDepth(), self.getSeed() & (2**63 - 1), min(self.getMaxBins(), 256)
        m = subset_size(self.getFeatureSubsetStrategy(), d, trees)

        read = rows.select("x", "weight").mapInArrow(_summaries(d), "f int, v binary, w binary").rdd
        summed = read.map(lambda r: (r.f, (np.frombuffer(r.v), np.frombuffer(r.w)))).reduceByKey(
            lambda a, b: _merged(np.append(a[0], b[0]), np.append(a[1], b[1]))).collectAsMap()  # SKETCH points a feature
        edges = [thresholds(*summed[f], n_bins) for f in range(d)]
        blocks = materialize(rows.mapInArrow(_blocks(edges), BLOCK_SCHEMA)).rdd.map(tuple)

        gains, tops = np.zeros((trees, d)), None
        if n <= TREE_ROWS:
            groups = min(trees, 2 * sc.defaultParallelism)
            dealt = blocks.flatMap(lambda row: [(g, row) for g in range(groups)]).partitionBy(groups, int)
            units = dealt.mapPartitionsWithIndex(_whole_trees(seed, trees, groups, d, classes, m, depth))
        else:
            tops = _tops(blocks, seed, trees, n, d, classes, m, depth, n_bins, gains)
            first = [0, *np.cumsum([len(t.feature) for t in tops]).tolist()]
            dealt = blocks.flatMap(_dealt(seed, tops, first, d)).partitionBy(first[-1], int)
            units = dealt.mapPartitions(_subtrees(seed, tops, d, classes, m, depth))
        path = shared_path(spark, f"forest-{uuid.uuid4().hex}")
        spark.createDataFrame(units, f"{UNIT_SCHEMA}, gains binary").write.parquet(os.path.join(path, "units"))
        for r in spark.read.parquet(f"{path}/units").select("tree", "gains").collect():  # features numbers a subtree
            gains[r.tree] += np.frombuffer(r.gains)
        each = gains.sum(axis=1, keepdims=True)
        share = np.divide(gains, each, out=np.zeros_like(gains), where=each > 0).sum(axis=0)
        share = share / share.sum() if share.sum() > 0 else share
        return ForestModel(path, trees, classes, self.getFeaturesCol(), edges, tops, [float(v) for v in share])
