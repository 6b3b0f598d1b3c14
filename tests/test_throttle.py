"""W7 batch (pointer doubling) equals the sequential greedy rule on dense data."""

import random

from flowlens.operators.throttle import alert_throttle


def _greedy(rows, cooldown):
    out = {}
    for key in sorted({r[0] for r in rows}):
        last = None
        for k, ident, t, pred in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1])):
            if pred != "Normal" and (last is None or t - last >= cooldown):
                last = t
                out[(key, ident)] = True
    return set(out)


def test_throttle_matches_greedy(spark):
    rnd = random.Random(7)
    rows = []
    for key in ["a", "b", "c"]:
        for i in range(600):
            t = round(rnd.uniform(0, 120), 2)  # dense: many threats per cooldown, ties included
            rows.append((key, i, t, "Normal" if rnd.random() < 0.3 else "DDoS"))
    df = spark.createDataFrame(rows, "key string, window_idx bigint, time_start double, prediction string")
    got = {(r["key"], r["window_idx"]) for r in alert_throttle(df).collect()}
    exp = _greedy(rows, 3.0)
    assert got == exp
    assert 40 <= len(exp) <= 130
