"""Plan guards: no cartesian / nested-loop joins, one fact scan per report."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from plan_report import summarise  # noqa: E402

from conftest import SF01  # noqa: E402

SINGLE_SCAN = ["heatmap", "kpi_row", "event_vs_month", "weekend_split",
               "block_activity", "top20_blocks", "keyword_routing", "daily_volume_lineitem"]
# exact percentiles: the report itself and two narrowing passes
THREE_SCANS = ["hourly_congestion", "daily_index", "hourly_congestion_lineitem"]
NO_PAIRS = SINGLE_SCAN + THREE_SCANS + ["regression_metrics", "best_fold", "chat_history", "feature_join", "routed_tables"]


def executed(spark, name):
    df = entry.queries()[name](spark, SF01)
    df.collect()  # so that the frame's own plan is the final one, with reused exchanges
    return summarise(df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_cartesian_or_nested_loop(spark, name):
    s = executed(spark, name)
    assert "CartesianProduct" not in s["joins"] and "BroadcastNestedLoopJoin" not in s["joins"]
    if name in SINGLE_SCAN:
        assert s["scans"] == 1, s
    if name in THREE_SCANS:
        assert s["scans"] <= 3, s


def test_event_day_filter_reaches_the_scan(spark):
    s = executed(spark, "event_day_large_transfers")
    assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in s["pushed"]), s["pushed"]


def test_building_the_feature_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "feature table")
    try:
        df = entry.queries()["feature_table"](spark, SF01)
        assert not tracker.getJobIdsForGroup("building")
        assert df.count() == 168
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_guarded_feature_table_fails_in_the_query(spark):
    from feescope.operators import features as FT
    from test_quality import grid, hourly, weekday

    bad = FT.guarded_feature_table(grid(spark, drop=(7, 2)), hourly(spark), weekday(spark))
    with pytest.raises(Exception, match="feature contract: 1 problems: Expected 168"):
        bad.collect()
