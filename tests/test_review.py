"""Inputs that the events adapter never makes: real CSV exports, exact rounding, weights, importances."""

import math

import pytest
from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flowlens.functions.packet import np_round, py_round
from flowlens.operators import eda, ml
from flowlens.operators.clean import clean_packets
from flowlens.operators.sample import downsample, sample_series
from flowlens.sources.packets import read_packets_csv


def _csv(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = _csv(tmp_path, "a.csv", 'Time,Extra,Info,No.,Length,Protocol,Destination,Source\n'
                '0.5,x,"GET ""a,b"" 1 > 80",7,60,TCP,10.0.0.2,10.0.0.1\n'
                '0.75,x,"C:\\dir\\",8,61,UDP,10.0.0.4,10.0.0.3\n')
    rows = read_packets_csv(spark, path).orderBy("no").collect()
    assert rows[0].asDict() == {"no": 7, "time": "0.5", "source": "10.0.0.1", "destination": "10.0.0.2", "protocol": "TCP",
                                "length": "60", "info": 'GET "a,b" 1 > 80'}
    assert (rows[1]["no"], rows[1]["info"]) == (8, "C:\\dir\\")


def test_csv_without_numbers_and_with_nan_times(spark, tmp_path):
    path = _csv(tmp_path, "b.csv", "Time,Source,Destination,Protocol,Length,Info\n"
                "1.0,a,b,TCP,60,x\nNaN,a,b,TCP,60,x\nnan,a,b,TCP,60,x\nbad,a,b,TCP,60,x\n2.0,a,b,TCP,60,x\n")
    raw = read_packets_csv(spark, path)
    assert [r["no"] for r in raw.collect()] == [None] * 5
    assert sorted(r["time"] for r in clean_packets(raw).collect()) == [1.0, 2.0]


def test_rounding_rules(spark):
    row = spark.createDataFrame([(2.675, 0.12345, -2.5, 123456.789, float("nan"), float("inf"), None)],
                                "a double, b double, c double, d double, e double, f double, g double").select(
        py_round("a", 2).alias("a"), py_round("b", 4).alias("b"), py_round("d", 1).alias("d"), py_round("e", 2).alias("e"),
        py_round("f", 2).alias("f"), py_round("g", 2).alias("g"), np_round("a", 2).alias("n")).first()
    assert (row["a"], row["b"], row["d"]) == (round(2.675, 2), round(0.12345, 4), round(123456.789, 1))
    assert math.isnan(row["e"]) and row["f"] == float("inf") and row["g"] is None and row["n"] == 2.68


def test_weights_count_train_rows_only(spark):
    df = spark.createDataFrame([(0, "train")] * 6 + [(1, "train")] * 2 + [(1, "test")] * 30, "Label int, split string")
    got = {r["Label"]: r["weight"] for r in ml.class_weights(df, train=df.where("split = 'train'")).collect()}
    assert got == pytest.approx({0: 8 / 12, 1: 8 / 4})


def test_importances_of_one_vs_rest_and_of_models_without(spark):
    rows = [(float(i % 2), Vectors.dense([i % 2 + 0.1 * (i % 3), 1.0 * (i % 5)])) for i in range(40)]
    df = spark.createDataFrame(rows, ["label", "features"])
    model = OneVsRest(classifier=LinearSVC(maxIter=20)).fit(df)
    imp = dict(ml.feature_importance((model, [0, 1]), "SVM (Linear)", ["x", "y"]))
    assert imp["x"] > imp["y"] >= 0
    assert ml.feature_importance(NaiveBayes().fit(df), "other", ["x", "y"]) == [("x", 0.5), ("y", 0.5)]


def test_downsample_has_one_plan_and_keeps_other_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("no"), (F.col("id") % 4).cast("int").alias("label")).unionByName(
        spark.createDataFrame([(5000, None)], "no bigint, label int"))
    got = downsample(df, 0.2, min_keep=10, labels=[0, 1])
    counts = {r[0]: r[1] for r in got.groupBy("label").count().collect()}
    assert counts == {0: 50, 1: 50, 2: 250, 3: 250, None: 1}
    kept = sorted(r["no"] for r in got.where("label = 0").collect())
    runs = sum(b - a == 4 for a, b in zip(kept, kept[1:]))
    assert runs < 25  # neighbours are not kept together
    assert downsample(df, 0.2, min_keep=300, labels=[0, 1]).count() == 1001
    assert sample_series(df.select(F.col("no").alias("window_idx"), F.col("no").alias("time_start")), 7).count() == 7


def test_histogram_bins_by_column_equal_those_by_number(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("k"), (F.col("id") * F.col("id") % 37).cast("double").alias("v"))
    both = eda.histogram(df.withColumn("b", F.when(F.col("k") == 0, 5).otherwise(9)), "v", "b", ["k"], density=True)
    for k, n in ((0, 5), (1, 9)):
        one = eda.histogram(df.where(F.col("k") == k), "v", n, ["k"], density=True)
        assert both.where(F.col("k") == k).exceptAll(one).isEmpty() and one.count() == n
