"""Shuffles that a step is done with are deleted before the next one, and tables in use stay."""

import time

from pyspark.sql import functions as F

from flowlens.llm import partenum
from flowlens.llm.common import cut, release


def shuffle_mb(spark) -> float:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    total = 0
    while files.hasNext():
        f = files.next()
        total += f.length() if f.getName().startswith("shuffle_") else 0
    return total / 1e6


def settled(spark, most: float) -> bool:
    for _ in range(5):  # Spark deletes in a thread of its own; its last job may still be referred to
        if shuffle_mb(spark) <= most:
            break
        release(cut(spark.range(1)))
        time.sleep(1)
    return shuffle_mb(spark) <= most


def test_release_deletes_the_shuffle_and_keeps_the_table(spark):
    release(spark.range(1))
    settled(spark, 0.0)
    before = shuffle_mb(spark)
    t = cut(spark.range(300_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(4, "id"))
    assert shuffle_mb(spark) > before + 10
    assert release(t) is t and settled(spark, before + 1)
    assert t.count() == 300_000


def test_the_join_releases_between_its_steps(spark, monkeypatch):
    left = []
    monkeypatch.setattr(partenum, "release", lambda df: left.append(df) or release(df))
    words = [" ".join(f"w{(i * 7 + j * (1 + i % 3)) % 400}" for j in range(60)) for i in range(40)]
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(words + words[:5])], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in partenum.jaccard_classes(docs).collect()}
    assert all(got[40 + i] == got[i] for i in range(5)) and len(got) == 45
    assert len(left) >= 7
