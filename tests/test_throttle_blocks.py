"""W7 batch over many blocks: the step functions of blocks and of groups of blocks carry the chain on."""

import random

import pytest
from test_throttle import _greedy

from flowlens.operators import throttle


@pytest.mark.parametrize("span", [2, 60, 4000])  # within one cooldown, dense, sparse; quarters of a second are exact
def test_blocks_equal_greedy(spark, monkeypatch, span):
    monkeypatch.setattr(throttle, "BLOCK", 7)
    monkeypatch.setattr(throttle, "FAN", 3)
    rnd = random.Random(span)
    rows = [(k, i, rnd.randrange(4 * span) / 4, "Normal" if rnd.random() < 0.2 else "DDoS") for k in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "key string, window_idx bigint, time_start double, prediction string")
    got = throttle.alert_throttle(df).collect()
    assert {(r.key, r.window_idx) for r in got} == _greedy(rows, 3.0)
    for key in ("a", "b"):
        mine = sorted((r.time_start, r.window_idx, r.alert_no) for r in got if r.key == key)
        assert [r[2] for r in mine] == list(range(1, len(mine) + 1))


def test_jobs_do_not_grow_with_the_chain(spark):
    """Pointer doubling ran two joins for every doubling of the chain's length: over 20 jobs for 600 alerts."""
    rows = [("a", i, float(10 * i), "DDoS") for i in range(600)]
    df = spark.createDataFrame(rows, "key string, window_idx bigint, time_start double, prediction string")
    calls = []
    keep = throttle.materialize
    throttle.materialize = lambda d: calls.append(1) or keep(d)
    try:
        assert throttle.alert_throttle(df).count() == 600
    finally:
        throttle.materialize = keep
    assert len(calls) <= 4
