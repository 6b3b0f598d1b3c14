"""Property tests (hypothesis): the keyed two-level rank equals row_number for random data
with heavy ties and random bucket counts; panes equal explode for random (size, step)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowlens.operators.packet_features import packet_features
from flowlens.operators.rank import packet_rank
from flowlens.operators.windows import window_features
from flowlens.plans.queries_prep import clean

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(
    times=st.lists(st.sampled_from([0.0, 1.5, 2.0, 2.0, 7.25, 100.0, -3.0]), min_size=1, max_size=300),
    keys=st.integers(min_value=1, max_value=4),
    buckets=st.integers(min_value=2, max_value=40),
)
def test_keyed_rank_equals_row_number(spark, times, keys, buckets):
    rows = [(i % keys, t, i) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k int, time double, no bigint")
    got = packet_rank(df, keys=["k"], num_buckets=buckets, total_col="n").select("k", "no", "rank", "n")
    w = Window.partitionBy("k").orderBy("time", "no")
    exp = df.select("k", "no", (F.row_number().over(w) - 1).alias("rank"), F.count("*").over(Window.partitionBy("k")).alias("n"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


@settings(**SETTINGS)
@given(size=st.integers(min_value=2, max_value=60), step=st.integers(min_value=1, max_value=60))
def test_panes_equal_explode_random(spark, size, step):
    f = packet_features(clean(spark, SF_SMALL).where(F.col("time") < 800_000), skew_safe=False)
    cols = ["window_idx", "pkt_count", "byte_total", "SYN_count", "n_unique_flows", "n_unique_dports", "Label"]
    a = window_features(f, size, step, method="explode").select(*cols)
    b = window_features(f, size, step, method="panes").select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
