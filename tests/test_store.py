from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import at, event_names, rows, sample, samples

from waitlens import sources
from waitlens.operators import dims, history, quality, reports, retention
from waitlens.plans import plan_rows, plan_table, render, render_first
from waitlens.schemas import SAMPLES, WAIT_GROUPS
from waitlens.views import register_views


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "samples")
    given = samples(spark, *[sample(f"{d} 12:00:00", dbid=b, session_id=d) for d in range(1, 11) for b in (1, 2)])
    sources.write_samples(given, path)
    return path


def test_store_round_trip_and_pruning(spark, stored):
    assert sources.read_samples(spark, stored).count() == 20
    part = sources.read_samples(spark, stored, at("3 12:00:00"), at("5 11:59:59"), target=(1, 1))
    assert rows(part, "dbid", "session_id") == [(1, 3), (1, 4)]
    plan = plan_text(part)
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "dbid" in filters and "sample_date" in filters
    assert "GreaterThanOrEqual(sample_time" in plan[plan.index("PushedFilters") :]


def test_reports_read_only_the_days_they_need(spark, stored):
    seen = history.session_history(sources.read_samples(spark, stored), event_names(spark))
    plan = plan_text(reports.db_time_by_sql(seen, at("5 13:00:00")))
    assert "sample_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_append_adds_and_overwrite_replaces_its_days(spark, stored):
    again = samples(spark, sample("3 12:00:00", session_id=33))
    sources.write_samples(again, stored)
    assert sources.read_samples(spark, stored).count() == 21
    sources.write_samples(again, stored, mode="overwrite")
    assert rows(sources.read_samples(spark, stored, at("3 00:00:00"), at("4 00:00:00")), "dbid", "session_id") == [(1, 33), (2, 3)]
    assert sources.read_samples(spark, stored).count() == 20


def test_a_busy_day_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        busy = spark.range(200_000).selectExpr(
            "1L as dbid", "1L as inst_id", "id as sample_id", "timestamp_seconds(1704103200 + id div 100) as sample_time", "id as session_id"
        )
        sources.write_samples(busy, str(tmp_path / "busy"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "busy" / "dbid=1").glob("*/*.parquet"))
    assert len(files) > 2
    assert sources.read_samples(spark, str(tmp_path / "busy")).count() == 200_000


def test_drop_expired_days(spark, stored):
    as_of = at("10 13:00:00")
    dropped = sources.drop_expired(spark, stored, "d", as_of)
    assert len(dropped) == 4
    left = sources.read_samples(spark, stored)
    # the limit is the 3rd at 13:00: its day is still stored, its row is expired
    assert left.count() == 16
    kept = retention.expire(left, "d", as_of)
    assert kept.count() == 14
    assert rows(retention.expire(kept, "d", as_of)) == rows(kept)
    assert sources.drop_expired(spark, stored, "d", as_of) == []


@pytest.mark.parametrize("mode, first", [("d", "24 00:00:00"), ("w", "1 00:00:00"), ("h", "30 00:00:00"), ("m", "30 23:30:00")])
def test_retention_modes(spark, mode, first):
    limit = at(first) if mode != "w" else at("1 00:00:00") - timedelta(days=1)
    df = samples(spark, sample("1 00:00:00")).selectExpr(
        f"explode(array(timestamp'{limit}', timestamp'{limit - timedelta(seconds=1)}')) as sample_time"
    )
    assert rows(retention.expire(df, mode, at("31 00:00:00"))) == [(limit,)]


def test_retention_unknown_mode(spark):
    with pytest.raises(ValueError):
        retention.expire(samples(spark, sample("1 00:00:00")), "x", at("2 00:00:00"))


def test_retention_by_snapshot(either):
    rows_ = either.createDataFrame([(1, 1, 1, 5), (2, 1, 1, 6), (1, 2, 1, 7), (3, 1, 1, 8)], "snap_id long, dbid long, inst_id long, v long")
    snaps = either.createDataFrame(
        [(1, 1, 1, at("1 00:00:00")), (2, 1, 1, at("20 00:00:00"))], "hist_sample_id long, dbid long, instance_number long, hist_date timestamp"
    )
    # another database's snapshot 1 and an unregistered one stay
    assert rows(retention.expire_by_snapshot(rows_, snaps, "d", at("20 00:00:00")), "v") == [(6,), (7,), (8,)]
    keep = timedelta(days=30)
    assert retention.expire_by_snapshot(rows_, snaps, "d", at("20 00:00:00"), keep=keep).count() == 4


def test_replace_partitions_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "stats")
    df = spark.createDataFrame([(1, 10), (2, 20)], "snap_id long, v long")
    for _ in range(2):
        sources.replace_partitions(df, path, ["snap_id"])
    assert rows(spark.read.parquet(path).select("snap_id", "v")) == [(1, 10), (2, 20)]


def test_write_new_refuses_an_existing_folder(spark, tmp_path):
    path = str(tmp_path / "dim")
    sources.write_new(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exist"):
        sources.write_new(spark.range(3), path)


def test_wait_groups_file(spark, tmp_path):
    file = tmp_path / "groups.csv"
    file.write_text('name,wait_class\nread,User I/O\nlock,"Configuration\n"\n')
    groups = sources.read_wait_groups(spark, str(file))
    assert groups.schema == WAIT_GROUPS
    result = dims.apply_wait_groups(event_names(spark).where("dbid = 1"), groups)
    assert rows(result.where("event_no = 2"), "wait_class") == [("Configuration",)]


def test_table_with_zoneless_time_is_conformed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as sample_time").write.parquet(path)
    assert sources.read_table(spark, path).schema["sample_time"].dataType.simpleString() == "timestamp"
    assert set(sources.read_table(spark, path, SAMPLES).columns) == set(SAMPLES.names)


LINES = "dbid long, inst_id long, sql_id string, plan_hash_value long, id long, parent_id long, depth long, operation string, options string, object_name string, cost long"


def lines(spark):
    return spark.createDataFrame(
        [
            (1, 1, "a", 7, 0, None, 0, "SELECT", None, None, 5),
            (1, 1, "a", 7, 1, 0, 1, "TABLE ACCESS", "FULL", "T", 5),
            (1, 2, "a", 7, 1, 0, 1, "TABLE ACCESS", "FULL", "T", 5),
            (1, 1, "a", 3, 0, None, 0, "SELECT", None, None, None),
            (1, 1, "b", 1, 0, None, 0, "SELECT", None, None, None),
        ],
        LINES,
    )


def test_plan_table_drops_copies_of_other_instances(spark):
    assert plan_rows(lines(spark), 1).count() == 5
    assert plan_table(lines(spark)).count() == 4
    assert plan_table(lines(spark), inst_id=2).count() == 1
    assert plan_rows(lines(spark), 2).count() == 0
    assert "projection" in plan_rows(lines(spark), compat=True).columns


def test_render(spark):
    texts = spark.createDataFrame([(1, "a", "y" * 400), (2, "a", "select")], "dbid long, sql_id string, sql_text string")
    got = [r.text for r in render(lines(spark), texts, "a").collect()]
    assert got == [
        "SQL ID a",
        "-" * 40,
        "select",
        " " * 40,
        "Plan hash value is :3",
        "   0 | SELECT",
        " " * 40,
        "Plan hash value is :7",
        "   0 | SELECT | cost=5",
        "   1 |  TABLE ACCESS FULL | T | cost=5",
    ]
    one = [r.text for r in render(lines(spark), texts, "a", plan=7).collect()]
    assert one[2:4] == ["select", "y" * 400] and one[5] == "Plan hash value is :7" and len(one) == 8
    short = [r.text for r in render(lines(spark), texts, "a", plan=7, text_chars=300).collect()]
    assert short[2:4] == ["select", "y" * 300]
    assert [r.text for r in render_first(lines(spark), "a").collect()] == ["Plan hash value is :3", "   0 | SELECT"]
    assert [r.text for r in render(lines(spark), texts, "none").collect()] == ["SQL ID none", "-" * 40]
    assert render_first(lines(spark), "none").count() == 0


def test_target_coverage(spark):
    targets = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "dbid long, inst_num long")
    df = samples(spark, sample("1 10:00:00"), sample("1 08:00:00", dbid=2))
    result = quality.target_coverage(targets, df, at("1 10:30:00"), timedelta(hours=1))
    assert rows(result, "dbid", "samples", "stale") == [(1, 1, False), (2, 1, True), (3, 0, True)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "dbid long, user_id long")
    assert rows(quality.duplicate_keys(df, ["dbid", "user_id"])) == [(1, 1, 2)]


def test_block_to_segment_ends(either):
    schema = "dbid long, session_id long, sample_id long, current_file long, current_block long"
    df = either.createDataFrame([(1, i, i, 1, b) for i, b in enumerate((9, 10, 5000, 10009, 10010))] + [(2, 9, 9, 1, 10)], schema)
    extents = either.createDataFrame([(1, 1, 10, 10000, "s")], "dbid long, file_id long, block_id long, blocks long, segment_name string")
    result = dims.block_to_segment(df, extents, width=64)
    assert rows(result, "current_block", "segment_name") == [(10, "s"), (10009, "s"), (5000, "s")]


def test_views_take_report_sql(spark):
    tables = {
        "samples": samples(spark, sample("1 10:00:00"), sample("1 10:00:00", dbid=2)),
        "event_names": event_names(spark),
        "snapshots": spark.createDataFrame([(1, 1, 1, at("1 10:00:00"))], "hist_sample_id long, dbid long, instance_number long, hist_date timestamp"),
        "plan_lines": lines(spark),
        "sqltext": spark.createDataFrame([(1, "a", "select")], "dbid long, sql_id string, sql_text string"),
        "users": spark.createDataFrame([(1, 5, "u")], "dbid long, user_id long, username string"),
    }
    names = register_views(spark, tables, target=(1, 1))
    assert "v$active_session_history" in names and "dba_hist_active_sess_history" in names
    assert spark.sql("select event, count(*) from `v$active_session_history` group by event").collect() == [("read", 1)]
    assert spark.sql("select snap_id from dba_hist_active_sess_history").collect() == [(1,)]
    assert spark.sql("select sql_text from `v$sql` where sql_id = 'a'").count() == 1
    assert spark.sql("select * from dba_users").count() == 1


def files_below(path) -> dict[str, float]:
    return {str(f): f.stat().st_mtime for f in path.rglob("*.parquet")}


@pytest.mark.parametrize("mode, kept", [("h", 24), ("m", 30)])
def test_hour_and_minute_retention_shrinks_the_files(spark, tmp_path, mode, kept):
    """The day that holds the limit is written anew, in the databases that hold older rows; the others stay as they are."""
    step = timedelta(hours=1) if mode == "h" else timedelta(minutes=1)
    end = at("9 12:00:00")
    given = [sample("1 00:00:00", sample_time=end - n * step, session_id=n) for n in range(60)]
    given += [sample("1 00:00:00", dbid=2, sample_time=end - n * timedelta(seconds=1), session_id=n) for n in range(5)]
    path = str(tmp_path / "s")
    sources.write_samples(samples(spark, *given), path)
    before = files_below(tmp_path / "s")
    sources.delete_expired(spark, path, mode, end)
    after = files_below(tmp_path / "s")
    left = spark.read.parquet(path)
    assert rows(left, "dbid", "session_id") == sorted([(1, n) for n in range(kept + 1)] + [(2, n) for n in range(5)], key=lambda r: tuple(map(str, r)))
    assert {f for f in before if "dbid=2" in f} == {f for f in after if "dbid=2" in f}
    assert sources.delete_expired(spark, path, mode, end) == [] and files_below(tmp_path / "s") == after


def test_a_day_without_rows_left_goes(spark, tmp_path):
    path = str(tmp_path / "s")
    sources.write_samples(samples(spark, sample("9 01:00:00"), sample("10 01:00:00", dbid=2)), path)
    dropped = sources.delete_expired(spark, path, "h", at("10 12:00:00"))
    assert [d.split("/s/")[1] for d in dropped] == ["dbid=1/sample_date=2024-01-09"]
    assert rows(spark.read.parquet(path), "dbid") == [(2,)]


def test_merge_touches_only_what_changes(spark, tmp_path):
    path, schema = str(tmp_path / "files"), "dbid long, file_id long, file_name string, tablespace_name string"
    first = spark.createDataFrame([(1, i, f"f{i}", "ts") for i in range(200)] + [(None, 1, "n", "ts")], schema)
    assert len(sources.merge_buckets(first, path, ["dbid", "file_id"], ["file_name"], 16)) == 16
    before = files_below(tmp_path / "files")
    assert sources.merge_buckets(first.limit(50), path, ["dbid", "file_id"], ["file_name"], 16) == []
    assert files_below(tmp_path / "files") == before
    updates = spark.createDataFrame([(1, 7, "new7", "other"), (1, 8, "f8", "other"), (1, 500, "f500", "ts"), (None, 1, "n", "x")], schema)
    touched = sources.merge_buckets(updates, path, ["dbid", "file_id"], ["file_name"], 16)
    assert 1 <= len(touched) <= 2
    after = files_below(tmp_path / "files")
    kept = {f: t for f, t in before.items() if not any(f"/bucket={b}/" in f for b in touched)}
    assert kept.items() <= after.items()
    got = {r[1]: r for r in rows(spark.read.schema(schema).parquet(path).drop("bucket")) if r[0] == 1}
    assert len(got) == 201 and got[7] == (1, 7, "new7", "ts") and got[8] == (1, 8, "f8", "ts") and got[500][2] == "f500"


def test_expired_snapshots_leave_the_files(spark, tmp_path):
    """A folder with targets of both sides of the limit keeps the rows of the younger ones."""
    store = sources.SnapshotStore(spark, str(tmp_path))
    run = store.begin()
    rows_of = spark.sql("select snap_id, dbid, 1L inst_id, snap_id * 10 + dbid as value from values (1L), (2L), (3L) as s(snap_id) cross join (values (1L), (2L)) as d(dbid)")
    run.write("io_events", rows_of)
    run.commit(spark.createDataFrame([(s, d, 1, at(f"{s + d} 00:00:00")) for s in (1, 2, 3) for d in (1, 2)], "hist_sample_id long, dbid long, instance_number long, hist_date timestamp"))
    before = files_below(tmp_path / "data")
    dropped = store.expire(at("4 00:00:00"), ["io_events"])
    assert [d.rsplit("/", 1)[1] for d in dropped] == ["snap_id=1"]
    assert rows(spark.read.parquet(f"{tmp_path}/data/io_events"), "value") == [(22,), (31,), (32,)]
    assert [f for f in files_below(tmp_path / "data") if "snap_id=3" in f] == [f for f in before if "snap_id=3" in f]
