"""M9: multi-class gradient boosting on binned features, one pass over the rows per tree level for all classes.

Every round fits one regression tree per class present in the training rows to the softmax gradients

    g = c * (p - [y = k]),   h = 2 * c * p * (1 - p)

(c: the row's weight, p: the row's probability of the class), with leaf value -rate * G / (H + lambda) and split gain
GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda); both sides of a split keep a Hessian of at least
``min_child_weight``. Features are binned once by quantiles (a mergeable sketch per feature), rows with x < edge go left.

A level of all trees of a round is one Spark job: each task adds its rows to a histogram per node, these are shuffled by
node, summed, and searched for the best edge where they meet. The driver gets one split per live node, a number set by
depth and classes, not by the rows. A fit has hundreds of such small jobs, so they run on an RDD of row blocks (a
DataFrame job of two Python stages takes about five times as long to start). The blocks carry their rows' margins and are
written anew every ``keep`` rounds (checkpoint in the shared folder); the trees grown since travel with the job. Sums of
several tasks are added in the order they arrive, so runs may differ in the last digits. Up to ``HERE_ROWS`` rows lie in one
task anyway, which then runs all rounds by itself, with the same sums: hundreds of jobs would take longer than their work.

Defined results: missing inputs (NaN) go right; of equal gains the first feature and its least edge win; a class without
training rows gets probability 0; no training rows raise a ValueError; a single class gives probability 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import materialize

#: rows of a task of a pass
TASK_ROWS = 1 << 18
#: up to so many rows all rounds run in one task
HERE_ROWS = 1 << 16
#: bytes of histograms that one task of the shuffled side sums
TASK_HIST = 64 << 20
#: gains up to this count as none
LEAST_GAIN = 1e-6


@dataclass
class Forest:
    """Trees as heaps (children of i: 2i + 1, 2i + 2): ``feature`` -1 at leaves, ``cut`` a bin or a value, one row per tree."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaves(self, tree: int, x: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row of x (rows x features, in the unit of ``cut``) comes to in at most ``depth`` steps."""
        node, row = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            f = self.feature[tree, node]
            inner = f >= 0
            if not inner.any():
                break
            right = ~(x[row, np.maximum(f, 0)] < self.cut[tree, node])
            node = np.where(inner, 2 * node + 1 + right, node)
        return node

    def margins(self, x: np.ndarray, classes: int, depth: int) -> np.ndarray:
        """Sum of the values of every class's trees; tree t belongs to class t % classes."""
        out = np.zeros((len(x), classes))
        for t in range(len(self.feature)):
            out[:, t % classes] += self.value[t, self.leaves(t, x, depth)]
        return out


def _stack(forests: list[Forest], nodes: int) -> Forest:
    none = [np.empty((0, nodes), np.int16), np.empty((0, nodes), np.int16), np.empty((0, nodes))]
    return Forest(*[np.concatenate([a] + [getattr(f, part) for f in forests])
                    for part, a in zip(("feature", "cut", "value"), none)])


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class BoostedTreesModel:
    """Fitted trees; ``transform`` adds ``probability``, an array over all ``n_classes`` classes."""

    classes: list[int]
    n_classes: int
    depth: int
    features: str
    trees: Forest
    gains: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        classes, n, depth, trees = self.classes, self.n_classes, self.depth, self.trees

        @F.pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            p = np.zeros((len(x), n))
            p[:, classes] = softmax(trees.margins(np.stack(x.to_list()), len(classes), depth))
            return pd.Series(list(p))

        return df.withColumn("probability", probability(vector_to_array(self.features)))

    def importances(self) -> list[float]:
        """Mean gain of a feature's splits, as a share of the sum over features (all 0 without a split)."""
        return self.gains

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        t = self.trees
        rows = [(i, [int(v) for v in t.feature[i]], [float(v) for v in t.cut[i]], [float(v) for v in t.value[i]])
                for i in range(len(t.feature))]
        spark.createDataFrame(rows, "tree int, feature array<int>, cut array<double>, value array<double>").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(self.classes, self.n_classes, self.depth, self.features, self.gains)],
                              "classes array<int>, n_classes int, depth int, features string, gains array<double>").coalesce(
            1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(path: str) -> BoostedTreesModel:
        spark = SparkSession.active()
        m = spark.read.parquet(f"{path}/model").first()
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r.tree)  # rounds x classes rows
        trees = Forest(np.array([r.feature for r in rows], np.int16), np.array([r.cut for r in rows]),
                       np.array([r.value for r in rows]))
        return BoostedTreesModel(list(m.classes), m.n_classes, m.depth, m.features, trees, list(m.gains))


BLOCK_SCHEMA = "bins binary, y binary, weight binary, margin binary"


def _block(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """One row that holds a block of training rows."""
    data = (bins.astype(np.int16), y.astype(np.int32), weight.astype(float), margin.astype(float))
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in data], names=["bins", "y", "weight", "margin"])


def _arrays(bins: bytes, y: bytes, weight: bytes, margin: bytes, d: int) -> tuple[np.ndarray, ...]:
    """bins (rows x features), class positions, weights and margins (rows x classes) of a block."""
    y = np.frombuffer(y, np.int32)
    n = len(y)
    return np.frombuffer(bins, np.int16).reshape(n, d), y, np.frombuffer(weight), np.frombuffer(margin).reshape(n, -1)


def _binned(edges: list[np.ndarray], classes: list[int]):
    """mapInArrow body: a block for every batch of rows, features as bins, margins 0."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy().reshape(b.num_rows, len(edges))
            bins = np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)], axis=1)
            yield _block(bins, np.searchsorted(classes, b.column("label").to_numpy()), b.column("weight").to_numpy(),
                         np.zeros((b.num_rows, len(classes))))

    return body


def _advanced(recent: Forest, d: int, k: int, depth: int):
    """mapInArrow body: blocks with the values of the recent trees added to their margins."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                bins, y, weight, margin = _arrays(**row, d=d)
                yield _block(bins, y, weight, margin + recent.margins(bins, k, depth))

    return body


def _histograms(recent: Forest, current: Forest, live: list[np.ndarray], d: int, n_bins: int, full_depth: int, depth: int):
    """mapPartitions body: (slot, sums of g and h by feature and bin) of a task's rows. ``live`` has each class's live
    nodes, sorted; nodes are numbered through all classes as slots."""
    k = len(live)
    first = np.concatenate([[0], np.cumsum([len(v) for v in live])])

    def body(rows: Iterator) -> Iterator[tuple[int, np.ndarray]]:
        sums = np.zeros((2, first[-1], d * n_bins))
        for row in rows:
            bins, y, weight, margin = _arrays(*row, d=d)
            _add(sums, bins, y, weight, softmax(margin + recent.margins(bins, k, full_depth)), current, live, n_bins, depth)
        for s in np.flatnonzero(sums[1].any(axis=1)):
            yield int(s), sums[:, s].reshape(2, d, n_bins)

    return body


def _add(sums: np.ndarray, bins: np.ndarray, y: np.ndarray, weight: np.ndarray, p: np.ndarray, current: Forest,
         live: list[np.ndarray], n_bins: int, depth: int) -> None:
    """Adds a block's gradients to the sums of g and h (slots x feature and bin) of all live nodes."""
    d = bins.shape[1]
    first = np.concatenate([[0], np.cumsum([len(v) for v in live])])
    feature = np.arange(d) * n_bins
    for c in range(len(live)):
        if not len(live[c]):
            continue
        node = current.leaves(c, bins, depth)
        slot = np.minimum(np.searchsorted(live[c], node), len(live[c]) - 1)
        inside = live[c][slot] == node
        pc, wc = p[inside, c], weight[inside]
        g, h = wc * (pc - (y[inside] == c)), np.maximum(2 * wc * pc * (1 - pc), 1e-16)
        cell = (slot[inside, None] * (d * n_bins) + feature + bins[inside]).ravel()
        for i, v in enumerate((g, h)):
            got = np.bincount(cell, np.repeat(v, d), len(live[c]) * d * n_bins)
            sums[i, first[c] : first[c + 1]] += got.reshape(len(live[c]), -1)


@dataclass
class Split:
    feature: int
    cut: int
    gain: float
    gl: float
    hl: float
    g: float
    h: float


def _best(n_edges: list[int], lam: float, least: float):
    """Sums of a node -> its best split. A cut j sends the bins below j left; without a lawful cut the gain is -inf."""

    def best(gh: np.ndarray) -> Split:
        left = np.cumsum(gh, axis=2)
        g, h = left[0, 0, -1], left[1, 0, -1]
        gl, hl = left
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = gl**2 / (hl + lam) + (g - gl) ** 2 / (h - hl + lam) - g**2 / (h + lam)
        lawful = (hl >= least) & (h - hl >= least) & (np.arange(gh.shape[2]) < np.array(n_edges)[:, None])
        gain = np.where(lawful, gain, -np.inf)
        f, j = divmod(int(np.argmax(gain)), gh.shape[2])
        return Split(f, j + 1, float(gain[f, j]), float(gl[f, j]), float(hl[f, j]), float(g), float(h))

    return best


@dataclass
class BoostedTrees:
    """Estimator with the interface of Spark ML's: ``fit(df)`` gives a ``BoostedTreesModel``."""

    features: str = "features"
    label: str = "Label"
    weight: str = "weight"
    n_classes: int = 5
    rounds: int = 100
    depth: int = 8
    rate: float = 0.1
    lam: float = 1.0
    min_child_weight: float = 1.0
    bins: int = 256
    keep: int = 10

    def _edges(self, rows: DataFrame, d: int) -> list[np.ndarray]:
        """Ascending finite edges of every feature: at most bins - 1 quantiles, the smallest value is none of them."""
        shares = [i / self.bins for i in range(1, self.bins)]
        finite = [F.when(F.isnan(F.col("x")[i]), F.lit(None)).otherwise(F.col("x")[i]) for i in range(d)]
        got = rows.agg(*[F.percentile_approx(c, shares, 10 * self.bins).alias(f"q{i}") for i, c in enumerate(finite)],
                       *[F.min(c).alias(f"m{i}") for i, c in enumerate(finite)]).first()
        out = []
        for i in range(d):
            e = np.unique(np.array(got[f"q{i}"] or [], float))
            out.append(e[np.isfinite(e) & (e > got[f"m{i}"])] if len(e) else e)
        return out

    def fit(self, df: DataFrame) -> BoostedTreesModel:
        raw = materialize(df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("int").alias("label"),
                                    F.col(self.weight).cast("double").alias("weight")))
        counts = {r.label: r.n for r in raw.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class
        if not counts:
            raise ValueError("no training rows")
        classes = sorted(counts)
        k, d, nodes = len(classes), raw.select(F.size("x")).first()[0], 2 ** (self.depth + 1) - 1
        edges = self._edges(raw, d)
        n_edges = [len(e) for e in edges]
        n_bins = max(n_edges) + 1
        tasks = -(-sum(counts.values()) // TASK_ROWS)
        rows = materialize(raw.repartition(tasks).mapInArrow(_binned(edges, classes), BLOCK_SCHEMA))
        blocks = rows.rdd

        if tasks == 1 and sum(counts.values()) <= HERE_ROWS:
            grown = blocks.mapPartitions(lambda rows: [self._rounds_here(rows, d, k, nodes, n_bins, n_edges)]).collect()
            done, gain_sum, gain_n = next(r for r in grown if r)
        else:
            done, gain_sum, gain_n = [], np.zeros(d), np.zeros(d)
            recent: list[Forest] = []
            for _ in range(self.rounds):
                before = _stack(recent, nodes)

                def splits(tree: Forest, live: list[np.ndarray], level: int) -> dict[int, Split]:
                    return self._splits(blocks, before, tree, live, d, n_bins, n_edges, level, tasks)

                tree = self._tree(k, nodes, splits, gain_sum, gain_n)
                recent.append(tree)
                done.append(tree)
                if len(recent) == self.keep:
                    rows = materialize(rows.mapInArrow(_advanced(_stack(recent, nodes), d, k, self.depth), BLOCK_SCHEMA))
                    blocks, recent = rows.rdd, []

        trees = _stack(done, nodes)
        cut = np.zeros(trees.cut.shape)
        for t, node in zip(*np.nonzero(trees.feature >= 0)):  # trees x nodes of the model
            cut[t, node] = edges[trees.feature[t, node]][trees.cut[t, node] - 1]
        mean = gain_sum / np.maximum(gain_n, 1)
        share = mean / mean.sum() if mean.sum() > 0 else mean
        return BoostedTreesModel(classes, self.n_classes, self.depth, self.features,
                                 Forest(trees.feature, cut, trees.value), [float(v) for v in share])

    def _tree(self, k: int, nodes: int, splits: Callable, gain_sum: np.ndarray, gain_n: np.ndarray) -> Forest:
        """One round: a tree per class, grown level by level by ``splits(trees, live nodes, level)``."""
        tree = Forest(np.full((k, nodes), -1, np.int16), np.zeros((k, nodes), np.int16), np.zeros((k, nodes)))
        live = [np.zeros(1, np.int64) for _ in range(k)]
        for level in range(self.depth):
            slots = [(c, int(node)) for c in range(k) for node in live[c]]
            if not slots:
                break
            grown: list[list[int]] = [[] for _ in range(k)]
            for s, r in sorted(splits(tree, live, level).items()):
                c, node = slots[s]
                if level == 0:
                    tree.value[c, 0] = -self.rate * r.g / (r.h + self.lam)
                if not r.gain > LEAST_GAIN:
                    continue
                tree.feature[c, node], tree.cut[c, node] = r.feature, r.cut
                gain_sum[r.feature] += r.gain
                gain_n[r.feature] += 1
                for child, g, h in ((2 * node + 1, r.gl, r.hl), (2 * node + 2, r.g - r.gl, r.h - r.hl)):
                    tree.value[c, child] = -self.rate * g / (h + self.lam)
                    if h >= 2 * self.min_child_weight:  # else no split of it is lawful
                        grown[c].append(child)
            live = [np.array(sorted(v), np.int64) for v in grown]
        return tree

    def _rounds_here(self, rows: Iterator, d: int, k: int, nodes: int, n_bins: int, n_edges: list[int]) -> tuple | None:
        """All rounds on the rows of one task; margins are added up as they are when written every ``keep`` rounds."""
        blocks = [_arrays(*row, d=d) for row in rows]
        if not blocks:
            return None
        margins, since = [b[3] for b in blocks], [np.zeros_like(b[3]) for b in blocks]
        done, gain_sum, gain_n = [], np.zeros(d), np.zeros(d)
        best = _best(n_edges, self.lam, self.min_child_weight)
        for n in range(self.rounds):
            p = [softmax(m + s) for m, s in zip(margins, since)]

            def splits(tree: Forest, live: list[np.ndarray], level: int) -> dict[int, Split]:
                sums = np.zeros((2, sum(len(v) for v in live), d * n_bins))
                for (bins, y, weight, _), q in zip(blocks, p):
                    _add(sums, bins, y, weight, q, tree, live, n_bins, level)
                return {int(s): best(sums[:, s].reshape(2, d, n_bins)) for s in np.flatnonzero(sums[1].any(axis=1))}

            tree = self._tree(k, nodes, splits, gain_sum, gain_n)
            done.append(tree)
            for (bins, *_), s in zip(blocks, since):
                s += tree.margins(bins, k, self.depth)
            if (n + 1) % self.keep == 0:
                margins, since = [m + s for m, s in zip(margins, since)], [np.zeros_like(s) for s in since]
        return done, gain_sum, gain_n

    def _splits(self, blocks: RDD, recent: Forest, tree: Forest, live: list[np.ndarray], d: int, n_bins: int,
                n_edges: list[int], level: int, tasks: int) -> dict[int, Split]:
        """The best split of every live node: at most nodes of a level x classes entries."""
        slots = sum(len(v) for v in live)
        meet = -(-slots * d * tasks * 16 * n_bins // TASK_HIST)
        sums = blocks.mapPartitions(_histograms(recent, tree, live, d, n_bins, self.depth, level))
        return sums.reduceByKey(np.add, meet).mapValues(_best(n_edges, self.lam, self.min_child_weight)).collectAsMap()
