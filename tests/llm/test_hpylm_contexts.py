"""Operator 9: a restaurant per word before, whatever the number of words."""

from math import isclose, log10

import numpy as np

from flowlens.llm import hpylm
from flowlens.llm.langid import fold
from pyspark.sql import functions as F


def _ids(spark):
    rows = spark.range(60).select("id", (fold(F.col("id"), 7) != 2).alias("train")).collect()
    return [r.id for r in rows if r.train], [r.id for r in rows if not r.train]


def test_every_word_before_has_its_own_restaurant(spark):
    # every word, and so every pair, occurs once: no seating is left to chance
    n = 5000
    train, held = _ids(spark)
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(train[0], " ".join(words)), (held[0], "w7 w8 w9"), (held[1], "w9 w7 new w1")], "doc_id long, text string")
    got = {r.doc_id: r for r in hpylm.score_documents(docs).collect()}
    v = n + 1  # and the end
    (d, theta), (d0, theta0) = hpylm.LEAF, hpylm.ROOT
    none = (theta0 + d0 * v) / (v + 1) / (theta0 + v)
    p = (1 - d0) / (theta0 + v) + none
    seen, known = (1 - d + (theta + d) * p) / (theta + 1), (theta + d) * p / (theta + 1)
    unknown, fresh = (theta + d) * none / (theta + 1), p
    assert isclose(got[train[0]].score, v * log10(seen), rel_tol=1e-9)
    assert isclose(got[held[0]].score, 2 * log10(seen) + 2 * log10(known), rel_tol=1e-9)  # w7 starts no text, no text ends by w9
    assert isclose(got[held[1]].score, 3 * log10(known) + log10(unknown) + log10(fresh), rel_tol=1e-9)


def test_frequent_pairs_score_as_rare_ones(spark, monkeypatch):
    # the same texts with and without ways of their own for frequent words and pairs: one model, other draws
    rng = np.random.default_rng(4)
    train, held = _ids(spark)
    rare = lambda: f"r{rng.integers(0, 400)}"
    docs = [(i, " ".join(x for _ in range(60) for x in ("of the", rare(), "a", rare()))) for i in (*train[:20], *held[:5])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    with_ = {r.doc_id: r for r in hpylm.score_documents(df).collect()}
    monkeypatch.setattr(hpylm, "HOT", 1)
    assert not len(hpylm.hot_words(df.select("text")).words)
    for r in hpylm.score_documents(df).collect():
        x = with_[r.doc_id]
        assert (x.n_tokens, x.n_known, x.train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        assert isclose(x.base_score, r.base_score, rel_tol=1e-9) and isclose(x.score, r.score, rel_tol=0.02)
