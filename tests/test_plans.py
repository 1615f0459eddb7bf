"""What the physical plans must and must not hold."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

from demo import registry

QUERIES = registry.queries()
BATCH = [name for name in QUERIES if not name.startswith("stream_") and name != "partitioned_roundtrip"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops_and_no_python(name, spark):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Pandas", "MapInArrow"):
        assert bad not in text


@pytest.mark.parametrize("name", ["session_history", "history_by_snapshot", "block_to_segment", "active_session_filter", "dim_append_new"])
def test_no_nested_loops_without_broadcast(name, shuffled):
    text = plan(QUERIES[name](shuffled, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Broadcast" not in text
    assert "SortMergeJoin" in text


@pytest.mark.parametrize("name", ["session_history", "active_session_filter", "metric_history"])
def test_facts_are_not_shuffled_for_small_names(name, spark):
    assert "Exchange hashpartitioning" not in plan(QUERIES[name](spark, SF_DIR))


def test_one_shuffle_for_top_sql(spark):
    text = plan(QUERIES["top_sql_by_wait_class"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in text and "Window" not in text


def test_time_range_reaches_the_scan(spark):
    text = plan(QUERIES["top_sql_by_wait_class"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in text


def test_hot_sql_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["hot_sql"](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", BATCH)
def test_no_single_partition_below_the_aggregate(name, spark):
    """Everything on one partition is allowed for totals only, which are one row per task before."""
    lines = plan(QUERIES[name](spark, SF_DIR)).split("\n")
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[number + 1]
            assert "Aggregate(key=[]" in below or "Aggregate(keys=[]" in below or "LocalLimit" in below


@pytest.mark.parametrize("name", ["stored_latest_sqlstats", "stored_metric_recent", "stored_history_by_snapshot"])
def test_stored_reads_are_pruned_at_run_time(name, spark):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "dynamicpruning" in text


def test_sql_functions_filter_the_scan(spark):
    text = plan(QUERIES["plan_display_sql"](spark, SF_DIR))
    assert "q7" in text[text.index("FileScan") :] and "Cartesian" not in text
