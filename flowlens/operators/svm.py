"""M8: one-vs-rest linear SVM with squared hinge loss, by Newton steps over all classes at once.

For every class k present in the training rows the problem is

    1/2 |w|^2 + C * sum_i c_i * max(0, 1 - y_i (w . x_i))^2

where x carries a constant 1 (the intercept is regularised as well), y is +1 for rows of the class and -1 for the others, and
c is the row's class weight for rows of the class and 1 for the others. A pass over the rows sums, for all classes,
the loss, its gradient and its generalised Hessian (the Gram matrix of the rows inside the margin) in numpy per
partition; the partial sums are added up by one aggregate, and only classes * features^2 numbers reach the driver, which
solves one small system per class. A step that does not lower the objective enough is halved. The objective is
piecewise quadratic and strictly convex, so a dozen or two passes reach the optimum, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import materialize

#: score of a class that the training rows do not hold
ABSENT = -1e300


@dataclass
class LinearOvrModel:
    """Coefficients (the intercept last) by class."""

    coefficients: dict[int, list[float]]
    n_classes: int
    features: str = "scaled"
    passes: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        """df + ``rawPrediction``: an array with the decision value of every class."""
        x = vector_to_array(self.features)

        def value(w: list[float]):
            along = F.zip_with(x, F.array(*[F.lit(float(c)) for c in w[:-1]]), lambda a, b: a * b)
            return F.aggregate(along, F.lit(float(w[-1])), lambda acc, v: acc + v)

        return df.withColumn("rawPrediction", F.array(*[
            value(self.coefficients[k]) if k in self.coefficients else F.lit(ABSENT) for k in range(self.n_classes)]))

    def importances(self) -> list[float]:
        """Mean absolute coefficient of each feature over the classes."""
        return [float(x) for x in np.abs([w[:-1] for w in self.coefficients.values()]).mean(axis=0)]

    def save(self, path: str) -> None:
        rows = [(k, [float(x) for x in w], self.n_classes, self.features, self.passes) for k, w in self.coefficients.items()]
        df = SparkSession.active().createDataFrame(rows, "cls int, w array<double>, n_classes int, features string, passes int")
        df.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str) -> LinearOvrModel:
        rows = SparkSession.active().read.parquet(path).collect()  # a row per class
        first = rows[0]
        return LinearOvrModel({r.cls: list(r.w) for r in rows}, first.n_classes, first.features, first.passes)


def _sums(classes: list[int], weights: np.ndarray):
    """mapInArrow body: one row of sums per partition, for every class the loss, its gradient and its Hessian."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = weights.shape[1]
        out = np.zeros((len(classes), 1 + d + d * d))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.empty((b.num_rows, d))
            x[:, -1] = 1.0
            x[:, :-1] = b.column("x").flatten().to_numpy().reshape(b.num_rows, d - 1)
            label, own = b.column("label").to_numpy(), b.column("weight").to_numpy()
            for i, k in enumerate(classes):
                y = np.where(label == k, 1.0, -1.0)
                short = 1.0 - y * (x @ weights[i])
                inside = short > 0
                z, s = x[inside], short[inside]
                c = np.where(label[inside] == k, own[inside], 1.0)
                out[i, 0] += (c * s * s).sum()
                out[i, 1 : 1 + d] -= 2 * z.T @ (c * s * y[inside])
                out[i, 1 + d :] += (2 * z.T @ (z * c[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([out.ravel()], pa.list_(pa.float64()))], names=["sums"])

    return body


@dataclass
class LinearOvrSvm:
    """Estimator with the interface of Spark ML's: ``fit(df)`` gives a ``LinearOvrModel``."""

    features: str = "scaled"
    label: str = "Label"
    weight: str = "weight"
    n_classes: int = 5
    c: float = 1.0
    tolerance: float = 1e-6
    max_passes: int = 100

    def fit(self, df: DataFrame) -> LinearOvrModel:
        rows = materialize(df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("int").alias("label"),
                                     F.col(self.weight).cast("double").alias("weight")))
        classes = sorted(r[0] for r in rows.select("label").distinct().collect())
        first = rows.select(F.size("x")).first()
        if first is None:
            raise ValueError("no training rows")
        d = first[0] + 1
        w = np.zeros((len(classes), d))

        def at(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            parts = rows.mapInArrow(_sums(classes, v), "sums array<double>").select(F.posexplode("sums").alias("p", "v"))
            flat = np.zeros(v.size + len(classes) * (1 + d * d))
            for r in parts.groupBy("p").agg(F.sum("v").alias("v")).collect():
                flat[r.p] = r.v
            flat = flat.reshape(len(classes), -1)
            loss = 0.5 * (v * v).sum(axis=1) + self.c * flat[:, 0]
            return loss, v + self.c * flat[:, 1 : 1 + d], np.eye(d) + self.c * flat[:, 1 + d :].reshape(-1, d, d)

        loss, grad, hess = at(w)
        goal = self.tolerance * np.maximum(1.0, np.linalg.norm(grad, axis=1))
        length, passes = np.ones(len(classes)), 1
        while passes < self.max_passes and (np.linalg.norm(grad, axis=1) > goal).any():
            step = np.linalg.solve(hess, grad[:, :, None])[:, :, 0]
            new = w - length[:, None] * step
            l2, g2, h2 = at(new)
            passes += 1
            good = l2 <= loss - 1e-4 * length * (grad * step).sum(axis=1) + 1e-12 * np.abs(loss)
            w[good], loss[good], grad[good], hess[good] = new[good], l2[good], g2[good], h2[good]
            length = np.where(good, 1.0, length / 2)
            if (length < 1e-9).any():
                break
        return LinearOvrModel({k: [float(x) for x in w[i]] for i, k in enumerate(classes)}, self.n_classes, self.features, passes)
