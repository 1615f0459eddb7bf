from __future__ import annotations

from datetime import timedelta

from conftest import SF_DIR, at, rows, sample, samples

from demo.fixtures import Tables
from waitlens import jobs
from waitlens.constants import METRIC_NAMES

STATS = "dbid long, instance_number long, sql_id string, plan_hash_value long, executions long"
TEXT = "dbid long, sql_id string, sql_text string"
LINES = "dbid long, inst_id long, sql_id string, plan_hash_value long, id long"


def inputs(spark):
    sources = {
        "sqlstats": spark.createDataFrame([(1, 1, "a", 0, 9), (1, 1, "b", 0, 4), (2, 1, "a", 0, 3)], STATS),
        "sqltext": spark.createDataFrame([(1, "a", "select a"), (1, "b", "select b")], TEXT),
        "plan_lines": spark.createDataFrame([(1, 1, "a", 0, 0), (1, 1, "a", 0, 1), (1, 1, "b", 0, 0)], LINES),
        "system_events": spark.createDataFrame([(1, 1, "log file sync", 3), (1, 1, "latch free", 4)], "dbid long, inst_id long, event string, total_waits long"),
        "instance_stats": spark.createDataFrame([(1, 1, 5, 50), (1, 1, 6, 60)], "dbid long, inst_id long, statistic long, value long"),
        "event_histogram": spark.createDataFrame([(1, 1, 1, 4, 2)], "dbid long, inst_id long, event_no long, wait_time_milli long, wait_count long"),
    }
    stored = {
        "samples": samples(spark, sample("1 10:00:00"), sample("1 10:00:00", dbid=2), sample("1 09:00:00", sql_id="b")),
        "sqlstats": spark.createDataFrame(
            [(1, 1, 1, "a", 0, 1), (2, 1, 1, "a", 0, 5), (1, 2, 1, "a", 0, 1), (2, 2, 1, "z", 0, 1)], "snap_id long, " + STATS
        ),
        "sqltext": spark.createDataFrame([(2, "a", "select a")], TEXT),
        "plan_lines": spark.createDataFrame([], LINES),
        "stat_names": spark.createDataFrame([(1, 5, 1), (1, 6, 0)], "dbid long, statistic long, collect long"),
        "targets": spark.createDataFrame([(1, 1), (2, 1)], "dbid long, inst_num long"),
    }
    return sources, stored


def test_snapshot_of_the_fleet(either):
    sources, stored = inputs(either)
    out = jobs.snapshot(sources, stored, 3, at("1 10:10:00"), columns=["executions"])
    # database 2 lacked the statement at its previous snapshot
    assert rows(out["sqlstats"], "snap_id", "dbid", "sql_id", "executions", "executions_delta") == [(3, 1, "a", 9, 4), (3, 2, "a", 3, None)]
    assert rows(out["sqltext"]) == [(1, "a", "select a", 1)]
    assert rows(out["plan_lines"], "sql_id", "id") == [("a", 0), ("a", 1)]
    assert rows(out["event_histogram"], "snap_id", "wait_count") == [(3, 2)]
    assert rows(out["io_events"], "snap_id", "event", "sample_time") == [(3, "log file sync", at("1 10:10:00"))]
    assert rows(out["instance_stats"], "statistic", "value", "sample_time") == [(5, 50, at("1 10:10:00"))]
    assert rows(out["snapshots"]) == [(3, 1, 1, at("1 10:10:00")), (3, 2, 1, at("1 10:10:00"))]


def test_snapshot_of_one_statement(either):
    sources, stored = inputs(either)
    out = jobs.snapshot_one(sources, stored, "b", 3, at("1 10:10:00"), columns=["executions"])
    assert rows(out["sqlstats"], "dbid", "sql_id", "executions", "executions_delta") == [(1, "b", 4, None)]
    assert rows(out["sqltext"]) == [(1, "b", "select b", 1)]
    assert rows(out["snapshots"], "dbid") == [(1,)]


def test_outputs_written_twice_add_nothing(spark, tmp_path):
    sources, stored = inputs(spark)
    out = jobs.snapshot(sources, stored, 3, at("1 10:10:00"), columns=["executions"])
    for _ in range(2):
        jobs.write_outputs(out, str(tmp_path), run="3")
    assert spark.read.parquet(f"{tmp_path}/sqlstats").count() == 2


def test_load_dimensions_is_repeatable(either):
    names = either.createDataFrame([(1, 1, METRIC_NAMES[0]), (1, 2, "Unlisted")], "dbid long, metric_id long, metric_name string")
    params = either.createDataFrame([(1, "p", "1"), (1, "p", "1")], "dbid long, name string, value string")
    stats = either.createDataFrame([(1, 1, "s")], "dbid long, statistic long, name string")
    empty = {"metric_names": names.limit(0), "params": params.limit(0), "stat_names": stats.limit(0).selectExpr("*", "0L as collect")}
    sources = {"metric_names": names, "params": params, "stat_names": stats}
    first = jobs.load_dimensions(sources, empty)
    assert {k: v.count() for k, v in first.items()} == {"params": 1, "stat_names": 1, "metric_names": 1}
    assert rows(first["stat_names"], "collect") == [(0,)]
    second = jobs.load_dimensions(sources, {k: empty[k].unionByName(v) for k, v in first.items()})
    assert all(v.count() == 0 for v in second.values())


def test_demo_snapshot_covers_all_parts(spark):
    t = Tables(spark, SF_DIR)
    out = jobs.snapshot({"users": t.customers()}, {"samples": t.samples(), "users": t.users()}, 1, at("31 00:00:00"), timedelta(days=7))
    assert list(out) == ["users"]
