"""W7 in batch: greedy alert throttling as a distributed algorithm.

Greedy rule (per key, in (time, id) order): the first threat alerts; after an alert at
time a, the next alert is the first threat with time >= a + cooldown.

1. Threats are ranked per key (two-level rank) and cut into blocks of BLOCK consecutive ranks.
2. A block is a step function from the last alert before it to the last alert in it: the chain can only enter at the
   times up to the first one a cooldown after the block's start, and chains that meet stay together, so few steps are left.
   The chain's end from every row is found by pointer doubling inside the block.
3. The functions of FAN consecutive blocks are composed to one, level by level; going back down, each block gets
   the last alert before it (a prefix scan, 2*log(blocks)/log(FAN) small jobs).
4. Each block picks its alerts, one search per alert.

No key or chain is held by one task: a task has a block of rows, or the steps of FAN blocks (as many as there are
different times within one cooldown of their starts, before equal results are merged).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.constants import ALERT_COOLDOWN_S
from flowlens.operators.rank import packet_rank
from flowlens.session import materialize

#: threats of a block, blocks of a group
BLOCK, FAN = 1 << 16, 32


def _merged(upto: np.ndarray, last: np.ndarray, through: bool) -> dict:
    """A step function: with x = last alert + cooldown, the first step with ``upto`` >= x gives the new last alert; behind all
    steps the old one stays (only where ``through``). Neighbours with the same result are one step."""
    keep = np.r_[last[1:] != last[:-1], True] if len(last) else np.zeros(0, bool)
    return {"upto": upto[keep], "last": last[keep], "through": through}


def _after(f: dict, a: np.ndarray, cooldown: float) -> np.ndarray:
    at = np.searchsorted(f["upto"], a + cooldown)
    return np.where(at < len(f["upto"]), f["last"][np.minimum(at, len(f["upto"]) - 1)], a)


def _block_steps(t: np.ndarray, cooldown: float) -> dict:
    """The step function of a block of ascending times."""
    nxt = np.searchsorted(t, t + cooldown)
    end = np.where(nxt < len(t), nxt, np.arange(len(t)))
    while True:
        far = end[end]
        if (far == end).all():
            break
        end = far
    n = int(np.searchsorted(t, t[0] + cooldown))  # rows that lie within a cooldown of the first; the next may be entered too
    times, first = np.unique(t[: n + 1], return_index=True)
    return _merged(times, t[end[first]], n >= len(t))


def _composed(fs: list[dict], cooldown: float) -> dict:
    out = fs[0]
    for f in fs[1:]:
        upto, last = out["upto"], _after(f, out["last"], cooldown)
        if out["through"]:
            later = f["upto"] > upto[-1]
            upto, last = np.r_[upto, f["upto"][later]], np.r_[last, f["last"][later]]
        out = _merged(upto, last, out["through"] and f["through"])
    return out


def _functions(pdf: pd.DataFrame) -> list[dict]:
    pdf = pdf.sort_values("_b")
    return [{"upto": np.asarray(u, float), "last": np.asarray(v, float), "through": bool(o)}
            for u, v, o in zip(pdf["upto"], pdf["last"], pdf["through"])]


def _last_before(ranked: DataFrame, key: str, time: str, cooldown: float) -> DataFrame:
    """(key, _b, _a): the last alert before each block, null for none."""
    kind = ranked.schema[key].dataType.simpleString()
    steps = f"`{key}` {kind}, _b bigint, upto array<double>, last array<double>, through boolean"

    def row(pdf: pd.DataFrame, b: int, f: dict) -> pd.DataFrame:
        return pd.DataFrame({key: [pdf[key].iloc[0]], "_b": [b], "upto": [f["upto"]], "last": [f["last"]], "through": [f["through"]]})

    def of_block(pdf: pd.DataFrame) -> pd.DataFrame:
        return row(pdf, int(pdf["_b"].iloc[0]), _block_steps(np.sort(pdf["_t"].to_numpy(float)), cooldown))

    def of_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return row(pdf, int(pdf["_b"].iloc[0]) // FAN, _composed(_functions(pdf), cooldown))

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_b")
        a = pdf["_a"].iloc[0]
        a = -np.inf if pd.isna(a) else float(a)
        before = []
        for f in _functions(pdf):
            before.append(a)
            a = float(_after(f, np.array([a]), cooldown)[0])
        return pd.DataFrame({key: pdf[key], "_b": pdf["_b"], "_a": [None if v == -np.inf else v for v in before]})

    blocks = ranked.select(key, F.col(time).cast("double").alias("_t"), "_b")
    levels = [materialize(blocks.groupBy(key, "_b").applyInPandas(of_block, steps))]
    most = (ranked.agg(F.max("_b")).first()[0] or 0) + 1
    group = F.floor(F.col("_b") / F.lit(FAN)).cast("bigint")
    while most > FAN:
        levels.append(materialize(levels[-1].groupBy(key, group).applyInPandas(of_group, steps)))
        most = -(-most // FAN)
    # a chain starts at rank 0; a key whose first ranks belong to threats without a time has none
    given = ranked.where(F.col("_r") == 0).select(key, F.lit(0).cast("bigint").alias("_g"), F.lit(None).cast("double").alias("_a"))
    for level in reversed(levels):
        known = level.withColumn("_g", group).join(given, [key, "_g"])
        given = materialize(known.groupBy(key, "_g").applyInPandas(down, f"`{key}` {kind}, _b bigint, _a double")).withColumnRenamed("_b", "_g")
    return given.withColumnRenamed("_g", "_b")


def alert_throttle(
    pred: DataFrame,
    key: str = "key",
    time: str = "time_start",
    ident: str = "window_idx",
    cooldown: float = ALERT_COOLDOWN_S,
    name: str = "prediction",
) -> DataFrame:
    """Alerts (rows of ``pred``) kept by the greedy cooldown rule, with ``alert_no`` (1-based per key)."""
    thr = pred.where(F.col(name) != F.lit("Normal"))
    ranked = materialize(packet_rank(thr, order_by=(time, ident), rank_col="_r", keys=[key]))
    if cooldown <= 0:
        return ranked.withColumn("alert_no", F.col("_r") + 1).drop("_r")

    ranked = ranked.withColumn("_b", F.floor(F.col("_r") / F.lit(BLOCK)).cast("bigint"))
    cooldown = float(cooldown)

    def picked(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_r")
        t, a = pdf["_t"].to_numpy(float), pdf["_a"].iloc[0]
        rows = []
        i = 0 if pd.isna(a) else int(np.searchsorted(t, float(a) + cooldown))
        while i < len(t):  # one step per alert
            rows.append(i)
            i = max(i + 1, int(np.searchsorted(t, t[i] + cooldown)))
        return pdf.iloc[rows][[key, "_r"]]

    rows = ranked.select(key, "_b", "_r", F.col(time).cast("double").alias("_t"))
    rows = rows.join(_last_before(ranked, key, time, cooldown), [key, "_b"])
    kind = ranked.schema[key].dataType.simpleString()
    marked = rows.groupBy(key, "_b").applyInPandas(picked, f"`{key}` {kind}, _r bigint")
    out = ranked.join(marked, [key, "_r"], "left_semi")
    numbered = packet_rank(out, order_by=(time, ident), rank_col="_a", keys=[key])
    return numbered.withColumn("alert_no", F.col("_a") + 1).drop("_r", "_b", "_a")
