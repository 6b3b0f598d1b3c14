"""Registered queries against their DuckDB oracle (row count, columns, value hash)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FAST = ["scan_packets", "clean_packets", "clean_packets_drop", "label_rule", "labeled_timeline", "enrich_hosts",
        "downsample", "packet_features", "packet_rank", "rank_by_label", "window_features", "window_features_explode",
        "training_windows", "length_hist", "protocol_top10", "iat_raw", "class_report", "tune_threshold", "tune_bias",
        "roc_auc_ovr", "confusion", "running_counters", "metrics_snapshots", "flow_statistics", "summary_class_dist"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "Label" in df.columns
