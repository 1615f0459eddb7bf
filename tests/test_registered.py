"""Every registered query against its SQL, with broadcast joins and with salted shuffle joins."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_module
import oracle_check
from demo import oracle, registry

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(name, spark, duck):
    assert oracle_check.difference(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


SHUFFLED = [
    "session_history",
    "top_sql_by_wait_class",
    "history_by_snapshot",
    "counter_delta",
    "latest_sqlstats",
    "metric_incremental",
    "metric_history",
    "event_histogram_named",
    "block_to_segment",
    "active_session_filter",
    "active_session_filter_v9",
    "dim_upsert",
    "wait_class_remap",
    "sql_text_new",
    "plan_lines_new",
    "sqlstats_hot",
    "retention_by_snapshot",
    "metric_summary_by_year",
    "dim_merge_buckets",
    "plan_tree",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_equals_sql_without_broadcast(name, shuffled, duck):
    assert oracle_check.difference(QUERIES[name](shuffled, SF_DIR), duck, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).columns[0] == "sql_id"
