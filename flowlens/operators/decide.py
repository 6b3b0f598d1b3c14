"""Decision rules and prediction columns (M11-M13, M27, M28) as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.constants import CLASS_NAMES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def argmax(arr) -> Column:
    """0-based index of the first maximum of an array."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def rest_argmax(p) -> Column:
    """1 + argmax over classes 1.. (the best non-normal class)."""
    a = _c(p)
    rest = F.slice(a, 2, F.size(a) - 1)
    return F.array_position(rest, F.array_max(rest)).cast("int")


def decide_threshold(p, t: float | Column) -> Column:
    """Class 0 iff P(class 0) >= t, else the best of the other classes."""
    a = _c(p)
    tt = t if isinstance(t, Column) else F.lit(float(t))
    return F.when(a[0] >= tt, F.lit(0)).otherwise(rest_argmax(a)).cast("int")


def two_column_scores(s) -> Column:
    """1-D decision scores become [-s, s]; arrays pass through."""
    return F.array(-_c(s), _c(s))


def decide_bias(s, b: float | Column) -> Column:
    """Add ``b`` to score 0, then argmax (first maximum wins)."""
    a = _c(s)
    bb = b if isinstance(b, Column) else F.lit(float(b))
    shifted = F.concat(F.array(a[0] + bb), F.slice(a, 2, F.size(a) - 1))
    return argmax(shifted)


def decide_argmax(p) -> Column:
    """Plain argmax."""
    return argmax(p)


def confidence_chosen(p, pred) -> Column:
    """Probability of the chosen class."""
    return F.element_at(_c(p), _c(pred) + 1)


def confidence_abs_max(s) -> Column:
    """M27 for score models: the largest absolute score."""
    return F.array_max(F.transform(_c(s), lambda x: F.abs(x)))


def prediction_name(pred) -> Column:
    from flowlens.functions.packet import class_name

    return class_name(_c(pred))


def proba_columns(df: DataFrame, p: str = "proba", digits: int = 4) -> DataFrame:
    """``proba_<Class>`` columns rounded to 4 decimals (numpy rounding)."""
    from flowlens.functions.packet import np_round

    cols = [np_round(F.col(p)[i], digits).alias(f"proba_{name}") for i, name in sorted(CLASS_NAMES.items())]
    return df.select("*", *cols)
