"""Plan shape: no single-partition window, no Python worker in batch feature plans,
pushed-down scan predicates, broadcast of bounded tables only."""

from conftest import SF_SMALL
from flowlens.operators.packet_features import packet_features
from flowlens.operators.rank import packet_rank
from flowlens.operators.windows import window_features
from flowlens.plans.queries_eval import counters
from flowlens.plans.queries_prep import clean
from flowlens.sources.packets import capture_frames_from_events, read_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_only_on_broadcast_side(plan: str) -> bool:
    """A single-partition exchange may only feed a broadcast (the bounded bucket-count
    prefix sum); row-level work must stay hash-partitioned."""
    lines = plan.splitlines()
    indent = lambda s: len(s) - len(s.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        owners = [j for j in range(i) if "BroadcastExchange" in lines[j] and indent(lines[j]) < indent(line)]
        if not owners:
            return False
    return True


def test_rank_has_no_single_partition_window(spark):
    p = _plan(packet_rank(clean(spark, SF_SMALL)))
    assert _single_partition_only_on_broadcast_side(p)
    assert "row_number() windowspecdefinition(_bkt" in p


def test_window_features_plan_is_jvm_only(spark):
    p = _plan(window_features(packet_features(clean(spark, SF_SMALL))))
    assert _single_partition_only_on_broadcast_side(p)
    for py in ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert py not in p


def test_running_counters_distributed(spark):
    assert _single_partition_only_on_broadcast_side(_plan(counters(spark, SF_SMALL)))


def test_capture_scan_pushes_time_range(spark):
    caps = capture_frames_from_events(read_table(spark, SF_SMALL, "events"))
    p = caps[1][1]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p
