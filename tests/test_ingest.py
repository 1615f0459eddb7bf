from __future__ import annotations

import pytest
from conftest import at, event_names, rows
from pyspark.sql import functions as F

from waitlens.constants import IO_EVENT_NAMES, METRIC_NAMES
from waitlens.operators import dims, ingest

RAW = (
    "dbid long, inst_id long, session_id long, sample_time timestamp, ksspaflg long, ksuseflg long, ksuseidl long,"
    " ksusetim long, ksuseopc long, ksuseblocker long, ksusefblocker long, ksusstmbv long, sql_child_number long,"
    " sql_exec_id long, plsql_entry_object_id long, plsql_entry_subprogram_id long, plsql_object_id long, plsql_subprogram_id long"
)


def raw(spark, *changes: dict):
    base = dict(
        dbid=1, inst_id=1, session_id=1, sample_time=at("1 00:00:00"), ksspaflg=1, ksuseflg=1, ksuseidl=1, ksusetim=0, ksuseopc=1,
        ksuseblocker=4294967291, ksusefblocker=4294967295, ksusstmbv=0, sql_child_number=2, sql_exec_id=5, plsql_entry_object_id=3,
        plsql_entry_subprogram_id=4, plsql_object_id=6, plsql_subprogram_id=7,
    )
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], RAW)


def kept(df) -> list[int]:
    return sorted(r.session_id for r in df.collect())


def test_activity_rule_v19(either):
    given = raw(
        either,
        {"session_id": 1},
        {"session_id": 2, "ksspaflg": 0},
        {"session_id": 3, "ksuseflg": 2},
        {"session_id": 4, "ksuseidl": 0},
        {"session_id": 5, "ksuseidl": 9},
        {"session_id": 6, "ksuseidl": 3},
        {"session_id": 7, "ksuseopc": 4},
        {"session_id": 8, "ksuseopc": 4, "dbid": 2},
        {"session_id": 9, "ksuseopc": None},
        {"session_id": 10},
    )
    # event 4 is idle in database 1 only; bit 2 of the idle flags does not matter here
    assert kept(ingest.active_sessions(given, event_names(either), exclude_session=10)) == [1, 6, 8]


def test_activity_rule_v10_sees_running_sessions_only(either):
    given = raw(
        either,
        {"session_id": 1, "ksusetim": 0},
        {"session_id": 2, "ksusetim": 5},
        {"session_id": 3, "ksusetim": 5, "ksuseidl": 3},
        {"session_id": 4, "ksusetim": 5, "ksuseopc": 4},
    )
    result = ingest.active_sessions(given, event_names(either), "v10")
    assert rows(result, "session_id", "session_state") == [(2, "ON CPU")]


def test_activity_rule_v9_running_or_busy_wait(either):
    names = event_names(either).withColumn("name", F.when(F.col("event_no") == 4, "PMON Timer").otherwise(F.col("name")))
    given = raw(
        either,
        {"session_id": 1, "ksuseidl": 0},
        {"session_id": 2, "ksuseopc": 4},
        {"session_id": 3, "ksuseopc": 4, "ksusetim": 1},
        {"session_id": 4, "ksuseopc": None},
        {"session_id": 5, "ksuseopc": None, "ksusetim": 1},
    )
    assert kept(ingest.active_sessions(given, names, "v9")) == [1, 3, 5]


def test_exclude_collector_of_each_target(either):
    given = raw(either, {"session_id": 1}, {"session_id": 2}, {"session_id": 1, "inst_id": 2})
    own = either.createDataFrame([(1, 1, 1)], "dbid long, inst_id long, session_id long")
    result = ingest.active_sessions(given, event_names(either), exclude_session=own)
    assert rows(result, "inst_id", "session_id") == [(1, 2), (2, 1)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        ingest.active_sessions(raw(spark, {}), event_names(spark), "v11")


def test_sentinels_become_null(spark):
    given = raw(
        spark,
        {"session_id": 1, "sql_child_number": 65535, "sql_exec_id": 0, "plsql_entry_object_id": 0, "ksusstmbv": 2048},
        {"session_id": 2, "plsql_object_id": 0, "plsql_subprogram_id": 0, "ksusstmbv": 2048},
        {"session_id": 3, "ksusstmbv": 1024},
        {"session_id": 4, "plsql_entry_object_id": None, "ksusstmbv": 4095},
    )
    result = ingest.active_sessions(given, event_names(spark))
    columns = ("sql_child_number", "sql_exec_id", "plsql_entry_object_id", "plsql_entry_subprogram_id", "plsql_object_id", "plsql_subprogram_id")
    assert rows(result, "session_id", *columns) == [
        (1, None, None, None, None, 6, 7),
        (2, 2, 5, 3, 4, None, None),
        (3, 2, 5, 3, 4, None, None),
        (4, 2, 5, None, 4, 6, 7),
    ]


@pytest.mark.parametrize(
    "layout, code, instance, session",
    [
        (16, 4294967295, None, None),
        (16, 4294967294, None, None),
        (16, 4294967293, None, None),
        (16, 4294967292, None, None),
        (16, 4294967291, None, None),
        (16, 4294967290, 32767, 65530),
        (16, 65536 * 2 + 77, 2, 77),
        (18, 262144 * 2 + 70000, 2, 70000),
        (18, 65536 * 2 + 77, 0, 131149),
        (16, None, None, None),
    ],
)
def test_blocker_layouts(spark, layout, code, instance, session):
    df = spark.createDataFrame([(code,)], "b long")
    assert rows(ingest.decode_blocker(df, "b", layout)) == [(code, instance, session)]


def test_blocker_layout_unknown(spark):
    with pytest.raises(ValueError):
        ingest.decode_blocker(spark.range(1), "id", 17)


def test_stamp_sets_target_and_one_id_per_poll(spark):
    df = spark.createDataFrame([(at("1 00:00:01"),), (at("1 00:00:01"),), (at("1 00:00:02"),)], "sample_time timestamp")
    result = ingest.stamp_samples(df, (7, 2))
    assert rows(result, "dbid", "inst_id", "sample_id") == [(7, 2, 1704067201), (7, 2, 1704067201), (7, 2, 1704067202)]


def users(spark, *ids):
    return spark.createDataFrame([(1, i, f"u{i}") for i in ids], "dbid long, user_id long, username string")


def test_append_new_with_stored_null_key(either):
    stored = users(either, 1, None)
    assert rows(ingest.append_new(users(either, 1, 2), stored, ["dbid", "user_id"])) == [(1, 2, "u2")]


def test_append_new_twice_adds_nothing(either):
    stored, source = users(either, 1), users(either, 1, 2, 3)
    once = stored.unionByName(ingest.append_new(source, stored, ["dbid", "user_id"]))
    assert ingest.append_new(source, once, ["dbid", "user_id"]).count() == 0


def test_append_strict(either):
    key = ["dbid", "user_id"]
    assert ingest.append_strict(users(either, 2, 3), users(either, 1), key).count() == 2
    assert ingest.append_strict(users(either, 1, 3), users(either, 1), key).count() == 0
    assert ingest.append_strict(users(either, 3, 3), users(either, 1), key).count() == 0
    with pytest.raises(ValueError):
        ingest.append_strict(users(either, 1, 3), users(either, 1), key, strict=True)
    assert ingest.append_strict(users(either, 2), users(either, 1), key, strict=True).count() == 1


def test_upsert_changes_named_columns_only(either):
    files = "dbid long, file_id long, file_name string, tablespace_name string"
    base = either.createDataFrame([(1, 1, "a", "t1"), (1, 2, "b", "t2"), (2, 1, "c", "t3"), (1, 1, "dup", "t4")], files)
    updates = either.createDataFrame([(1, 1, None, "x"), (1, 3, "n", "y")], files)
    result = ingest.upsert(base, updates, ["dbid", "file_id"], ["file_name"])
    assert rows(result) == [(1, 1, None, "t1"), (1, 1, None, "t4"), (1, 2, "b", "t2"), (1, 3, "n", "y"), (2, 1, "c", "t3")]


def test_select_names_default_list(spark):
    df = spark.createDataFrame([(1, METRIC_NAMES[0]), (1, METRIC_NAMES[0]), (1, "Other Metric")], "id int, metric_name string")
    assert rows(ingest.select_names(df)) == [(1, METRIC_NAMES[0])]


def test_io_event_snapshot(spark):
    df = spark.createDataFrame([(IO_EVENT_NAMES[2], 5), ("latch free", 6)], "event string, total_waits long")
    assert rows(ingest.io_event_snapshot(df, 9, (1, 2))) == [(IO_EVENT_NAMES[2], 5, 9, 1, 2)]


def test_flagged_stats_by_database(either):
    stats = either.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], "dbid long, statistic long, value long")
    names = either.createDataFrame([(1, 1, 1), (1, 2, 0), (2, 1, 0)], "dbid long, statistic long, collect long")
    assert rows(ingest.flagged_stats(stats, names), "dbid", "statistic", "value") == [(1, 1, 5)]


def test_metric_increment(either):
    schema = "dbid long, inst_id long, begin_time timestamp, intsize_csec long, metric_id long, value double"
    source = either.createDataFrame(
        [
            (1, 1, at("10 00:00:00"), 6000, 1, 1.0),
            (1, 1, at("10 00:01:00"), 6000, 1, 2.0),
            (1, 1, at("10 00:01:00"), 2000, 1, 3.0),
            (1, 1, at("10 00:01:00"), 6000, 9, 4.0),
            (1, 2, at("1 00:00:00"), 6000, 1, 5.0),
            (1, 2, at("9 00:00:00"), 6000, 1, 6.0),
        ],
        schema,
    )
    loaded = source.where("inst_id = 1 and begin_time = timestamp'2024-01-10 00:00:00'")
    names = either.createDataFrame([(1, 1), (2, 9)], "dbid long, metric_id long")
    # instance 2 was never loaded: 5 days back from the 10th
    result = ingest.metric_increment(source, loaded, names, at("10 12:00:00"), first_load_days=5)
    assert rows(result, "inst_id", "value") == [(1, 2.0), (2, 6.0)]


def test_wait_groups_remap(either):
    groups = either.createDataFrame([("read", "User I/O"), ("lock", "Configuration\n"), ("lock", "Configuration")], "name string, wait_class string")
    result = dims.apply_wait_groups(event_names(either).where("dbid = 1"), groups)
    assert rows(result, "event_no", "wait_class") == [(1, "User I/O"), (2, "Configuration"), (3, None), (4, None)]
    assert result.columns == event_names(either).columns
