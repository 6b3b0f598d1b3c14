"""Operator 4 and the pipeline's second stage: slot counts of large groups travel packed."""

import numpy as np

from flowlens.llm import partenum as pe


def test_slot_counts_are_packed_and_exact(spark):
    rng = np.random.default_rng(11)
    few = rng.integers(0, pe.SLOTS, 3000)
    sets = []
    for i in range(60):  # slot few[j] occurs in the first j % 40 sets, twice where a set holds two shingles of it
        own = few[np.arange(len(few)) % 40 > i].astype(np.uint64)
        sets.append(np.r_[own, own[::7] + np.uint64(pe.SLOTS), rng.integers(0, 1 << 62, 500).astype(np.uint64)])
    n = np.bincount((np.concatenate(sets) % np.uint64(pe.SLOTS)).astype(np.int64), minlength=pe.SLOTS)
    df = spark.createDataFrame([(bytearray(s.tobytes()),) for s in sets], "items binary").repartition(7)
    assert (pe.frequent_slots(df) == np.packbits(n > pe.LARGE, bitorder="little")).all()
    rows = df.mapInArrow(pe._slot_counts, "piece int, slots binary, counts binary").count()
    assert rows <= 7 * pe.SLOTS // pe.SLOT_PIECE  # a row per piece and partition, not per slot
    assert not pe.frequent_slots(df.limit(0)).any()
