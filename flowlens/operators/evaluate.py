"""Evaluation tables and decision-rule search.

Everything is computed from small count tables: the scored rows are aggregated once
(map-side combine), and only those aggregates are expanded by a search grid. No cross
join of the scored rows with the grid, and no row is visited once per grid value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.constants import BIAS_GRID, CLASS_NAMES, THRESHOLD_GRID
from flowlens.functions.packet import class_name
from flowlens.operators.decide import rest_argmax
from flowlens.operators.rank import running_sums


def grid(spec: tuple[float, float, int]) -> list[float]:
    """The search grid with numpy's linspace values (exactly the same doubles)."""
    lo, hi, n = spec
    return [float(x) for x in np.linspace(lo, hi, n)]


def report_from_counts(counts: DataFrame, keys: Sequence[str] = (), y: str = "y", pred: str = "pred",
                       n: str = "n") -> DataFrame:
    """M18 from a (keys, y, pred, n) count table: per-class precision, recall, F1 and
    support over the labels present in y or pred (0 on 0/0), plus accuracy, macro and
    weighted averages. Output rows: keys..., cls (string), precision, recall, f1, support."""
    keys = list(keys)
    per_y = counts.groupBy(*keys, F.col(y).alias("c")).agg(F.sum(n).alias("sup"),
                                                           F.sum(F.when(F.col(y) == F.col(pred), F.col(n)).otherwise(0)).alias("tp"))
    per_p = counts.groupBy(*keys, F.col(pred).alias("c")).agg(F.sum(n).alias("pp"))
    pc = per_y.join(per_p, [*keys, "c"], "full").select(
        *keys, "c", F.coalesce("sup", F.lit(0)).alias("sup"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("pp", F.lit(0)).alias("pp"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("sup")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide((F.col("tp") * 2).cast("double"), F.col("sup") + F.col("pp")), F.lit(0.0))
    per = pc.select(*keys, "c", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), F.col("sup").alias("support"),
                    "tp")
    tot = per.groupBy(*keys).agg(
        F.sum("support").alias("total"), F.sum("tp").alias("tp_all"),
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        F.sum(F.col("precision") * F.col("support")).alias("w_p"), F.sum(F.col("recall") * F.col("support")).alias("w_r"),
        F.sum(F.col("f1") * F.col("support")).alias("w_f"),
    )
    classes = per.select(*keys, class_name(F.col("c")).alias("cls"), "precision", "recall", "f1",
                         F.col("support").cast("bigint").alias("support"))
    acc = F.coalesce(F.try_divide(F.col("tp_all").cast("double"), F.col("total")), F.lit(0.0))
    wdiv = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("total").cast("double")), F.lit(0.0))
    summary = tot.select(*keys, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("cls"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("total").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("cls"), F.col("m_p").alias("precision"), F.col("m_r").alias("recall"),
                 F.col("m_f").alias("f1"), F.col("total").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("cls"), wdiv("w_p").alias("precision"), wdiv("w_r").alias("recall"),
                 wdiv("w_f").alias("f1"), F.col("total").cast("bigint").alias("support")),
    )).alias("s")).select(*keys, "s.*")
    return classes.unionByName(summary)


def _grid_index(values: list[float], satisfied) -> Column:
    """Number of grid values for which ``satisfied(value)`` holds (a prefix/suffix set)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.size(F.filter(arr, satisfied)).cast("int")


def threshold_table(scored: DataFrame, y: str = "y", p: str = "proba", spec=THRESHOLD_GRID) -> DataFrame:
    """Macro F1 of the threshold rule for every grid value. Rows: t, macro_f1.

    A row predicts 0 for the thresholds t <= p0 (a prefix of the ascending grid, of
    length k) and its best other class otherwise; rows are therefore aggregated to
    (y, alt, k) counts first, and only that small table meets the grid."""
    g = grid(spec)
    small = scored.groupBy(
        F.col(y).alias("y"), rest_argmax(p).alias("alt"), _grid_index(g, lambda t: F.col(p)[0] >= t).alias("k")
    ).agg(F.count(F.lit(1)).alias("n"))
    gi = F.explode(F.sequence(F.lit(0), F.lit(len(g) - 1)))
    expanded = small.select("y", "alt", "k", "n", gi.alias("i")).select(
        "i", "y", F.when(F.col("i") < F.col("k"), F.lit(0)).otherwise(F.col("alt")).alias("pred"), "n")
    counts = expanded.groupBy("i", "y", "pred").agg(F.sum("n").alias("n"))
    rep = report_from_counts(counts, ["i"]).where(F.col("cls") == "macro avg")
    tvals = F.array(*[F.lit(v) for v in g])
    return rep.select(F.element_at(tvals, F.col("i") + 1).alias("t"), F.col("f1").alias("macro_f1"))


def bias_table(scored: DataFrame, y: str = "y", s: str = "score", spec=BIAS_GRID) -> DataFrame:
    """Macro F1 of the bias rule for every grid value. Rows: b, macro_f1.
    Class 0 wins for the biases with s0 + b >= max(others) (a suffix of the grid)."""
    g = grid(spec)
    rest = F.slice(F.col(s), 2, F.size(F.col(s)) - 1)
    m = F.array_max(rest)
    small = scored.groupBy(
        F.col(y).alias("y"), rest_argmax(s).alias("alt"),
        _grid_index(g, lambda b: (F.col(s)[0] + b) >= m).alias("k"),
    ).agg(F.count(F.lit(1)).alias("n"))
    gi = F.explode(F.sequence(F.lit(0), F.lit(len(g) - 1)))
    expanded = small.select("y", "alt", "k", "n", gi.alias("i")).select(
        "i", "y", F.when(F.col("i") >= F.lit(len(g)) - F.col("k"), F.lit(0)).otherwise(F.col("alt")).alias("pred"), "n")
    counts = expanded.groupBy("i", "y", "pred").agg(F.sum("n").alias("n"))
    rep = report_from_counts(counts, ["i"]).where(F.col("cls") == "macro avg")
    bvals = F.array(*[F.lit(v) for v in g])
    return rep.select(F.element_at(bvals, F.col("i") + 1).alias("b"), F.col("f1").alias("macro_f1"))


def best_of(table: DataFrame, value: str) -> DataFrame:
    """Highest macro F1; ties -> the lowest grid value (strict '>' while scanning upward)."""
    return table.orderBy(F.desc("macro_f1"), F.asc(value)).limit(1)


def tune_threshold(scored: DataFrame, y: str = "y", p: str = "proba") -> DataFrame:
    return best_of(threshold_table(scored, y, p), "t")


def tune_bias(scored: DataFrame, y: str = "y", s: str = "score") -> DataFrame:
    return best_of(bias_table(scored, y, s), "b")


def class_dim_pairs(spark) -> DataFrame:
    ids = sorted(CLASS_NAMES)
    return spark.createDataFrame([(a, b) for a in ids for b in ids], "actual int, predicted int")


def confusion(pred_df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """5x5 counts, rows = actual, every class pair listed (fixed 25-row grid, broadcast)."""
    c = pred_df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))
    g = F.broadcast(class_dim_pairs(pred_df.sparkSession))
    return g.join(c, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def confusion_norm(conf: DataFrame) -> DataFrame:
    """Each row divided by max(row sum, 1)."""
    w = Window.partitionBy("actual")
    return conf.select("actual", "predicted", "count",
                       (F.col("count") / F.greatest(F.sum("count").over(w), F.lit(1))).alias("share"))


def class_report(pred_df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    counts = pred_df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    return report_from_counts(counts)


def roc_auc_ovr(scored: DataFrame, y: str = "y", p: str = "proba", n_classes: int | None = None) -> DataFrame:
    """One-vs-rest ROC-AUC per class and their macro mean (rows: cls, auc).

    Exact Mann-Whitney form with half credit for ties: rows are unpivoted to
    (class, score, positive), counted per distinct (class, score), and the negatives
    below each score come from a two-level running sum (no class is ever handled by a
    single task). A class without positives or negatives makes the macro value null.
    """
    k = n_classes or len(CLASS_NAMES)
    un = scored.select(F.col(y).alias("_y"), F.posexplode(F.slice(F.col(p), 1, k)).alias("c", "s"))
    per = un.groupBy("c", "s").agg(
        F.sum(F.when(F.col("_y") == F.col("c"), 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("_y") != F.col("c"), 1).otherwise(0)).alias("neg"),
    )
    cum = running_sums(per, {"neg_le": F.col("neg")}, order_by=("s", "s"), keys=["c"])
    contrib = cum.select("c", "pos", "neg", (F.col("pos") * ((F.col("neg_le") - F.col("neg")) + 0.5 * F.col("neg"))).alias("u"))
    auc = contrib.groupBy("c").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("u").alias("U")).select(
        "c", F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("U") / (F.col("P") * F.col("N"))).alias("auc"))
    per_class = auc.select(class_name(F.col("c")).alias("cls"), "auc")
    macro = auc.agg(F.when(F.count_if(F.col("auc").isNull()) == 0, F.avg("auc")).alias("auc")).select(
        F.lit("macro").alias("cls"), "auc")
    return per_class.unionByName(macro)


def comparison(metrics: DataFrame) -> DataFrame:
    """One row per model, by F1 descending (name breaks ties)."""
    return metrics.orderBy(F.desc("f1"), F.asc("model"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The first row of the comparison."""
    return comparison(metrics).limit(1)
