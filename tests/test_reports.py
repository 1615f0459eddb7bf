from __future__ import annotations

from datetime import timedelta

from conftest import at, event_names, rows, sample, samples
from pyspark.sql import functions as F

from waitlens.operators import history, hot, reports


def seen(spark, *given):
    return history.session_history(samples(spark, *given), event_names(spark))


def test_top_sql_classes_and_ties(either):
    given = (
        [sample("1 00:00:00", sql_id="a")] * 2
        + [sample("1 00:00:00", sql_id="b", session_state="ON CPU"), sample("1 00:00:00", sql_id="b", event_no=2)]
        + [sample("1 00:00:00", sql_id=None)] * 5
        + [sample("1 00:00:00", sql_id="c", event_no=4), sample("1 00:00:00", sql_id="c", event_no=3)]
        + [sample("1 00:00:00", sql_id="d", session_state="IDLE")] * 9
        + [sample("1 00:00:01", sql_id="a")]
    )
    result = reports.top_sql_by_wait_class(seen(either, *given), at("1 00:00:00"), at("1 00:00:00"), n=2)
    got = [r.asDict() for r in result.collect()]
    assert [r["sql_id"] for r in got] == ["a", "b"]
    assert got[0]["User I/O"] == 2 and got[0]["CPU"] is None and got[0]["Total"] == 2
    assert got[1]["Concurrency"] == 1 and got[1]["CPU"] == 1 and got[1]["Total"] == 2
    wider = reports.top_sql_by_wait_class(seen(either, *given), at("1 00:00:00"), at("1 00:00:00"))
    # an idle wait is counted in the total and shown in no class
    assert rows(wider.where("sql_id = 'c'"), "Other", "Total") == [(1, 2)]


def test_reports_over_samples_equal_those_over_the_history(either):
    given = [
        sample(f"1 10:{m:02d}:00", session_id=m % 3, event_no=e, sql_id=q, session_state=s, session_type=t)
        for m in range(0, 60, 7)
        for e in (1, 2, 3, 4, 99)
        for q, t in (("a", 1), (None, 2), ("b", 17))
        for s in ("WAITING", "ON CPU", "?")
    ]
    stored, names = samples(either, *given), event_names(either)
    named = history.session_history(stored, names)
    start, stop = at("1 10:00:00"), at("1 11:00:00")
    assert rows(reports.top_sql_by_wait_class(stored, start, stop, event_names=names)) == rows(
        reports.top_sql_by_wait_class(named, start, stop)
    )
    assert rows(reports.db_time_by_sql(stored, stop, event_names=names)) == rows(reports.db_time_by_sql(named, stop))
    assert rows(reports.activity_graph(stored, names, stop, stored=True)) == rows(reports.activity_graph(named, names, stop))


def test_empty_window(spark):
    rows_ = seen(spark, sample("1 00:00:00"))
    assert reports.top_sql_by_wait_class(rows_, at("2 00:00:00"), at("3 00:00:00")).count() == 0
    assert reports.top_sessions(rows_, at("3 00:00:00")).count() == 0
    graph = reports.activity_graph(rows_, event_names(spark), at("3 00:00:00"), 2)
    assert rows(graph.where("wait_order is null").groupBy("wait_class").count()) == [("null", 8)]


def test_window_leaves_out_its_early_end(spark):
    rows_ = seen(spark, sample("1 10:00:00", session_id=1), sample("1 10:00:01", session_id=2), sample("1 11:00:00", session_id=3), sample("1 11:00:01", session_id=4))
    assert rows(reports.top_sessions(rows_, at("1 11:00:00")), "session_id", "cnt", "pctload") == [(2, 1, 50.0), (3, 1, 50.0)]


def test_percent_is_rounded_half_up_and_adds_to_hundred(spark):
    given = [sample("1 10:00:00", session_id=i % 7) for i in range(800)]
    result = reports.top_sessions(seen(spark, *given), at("1 10:00:00"))
    assert abs(result.agg(F.sum("pctload")).collect()[0][0] - 100) <= 0.01 * 7
    eighth = reports.load_by(seen(spark, *[sample("1 10:00:00", session_id=i) for i in range(8)] * 100), ["session_id"])
    assert rows(eighth.select("pctload").distinct()) == [(12.5,)]
    skew = [sample("1 10:00:00", session_id=1)] + [sample("1 10:00:00", session_id=2)] * 1599
    # 100 / 1600 = 0.0625
    assert rows(reports.load_by(seen(spark, *skew), ["session_id"]), "session_id", "pctload") == [(1, 0.06), (2, 99.94)]


def test_background_is_left_out_of_db_time(spark):
    rows_ = seen(spark, sample("1 10:00:00", session_type=17), sample("1 10:00:05", session_type=4), sample("1 10:00:50", session_state="ON CPU"))
    result = reports.db_time_by_sql(rows_, at("1 10:30:00"))
    assert rows(result, "sample_time", "event", "cnt", "pctload") == [(at("1 10:00:00"), "ON CPU", 1, 50.0), (at("1 10:00:00"), "read", 1, 50.0)]


def test_drills(spark):
    rows_ = seen(
        spark,
        sample("1 10:00:00", session_id=5),
        sample("1 09:00:00", session_id=5, event_no=2),
        sample("1 10:00:00", session_id=6, session_type=17),
    )
    as_of = at("1 10:10:00")
    assert reports.event_rows(rows_, "read", as_of).count() == 1
    assert reports.event_details(rows_, "read", as_of).columns == ["sample_time", "session_state"]
    assert [r.sample_time for r in reports.session_details(rows_, 5, as_of).collect()] == [at("1 10:00:00"), at("1 09:00:00")]
    assert rows(reports.session_events(rows_, 5, as_of)) == [("lock", 1, 50.0), ("read", 1, 50.0)]
    assert rows(reports.session_sqls(rows_, 5, as_of)) == [("a", 0, 2, 100.0)]
    assert rows(reports.session_sql_events(rows_, 5, as_of)) == [("lock", "a", 0, 1, 50.0), ("read", "a", 0, 1, 50.0)]


def test_activity_graph_across_midnight(spark):
    given = [sample("1 23:59:50")] * 30 + [sample("2 00:00:05", session_state="ON CPU")] * 15 + [sample("2 00:00:05", session_state="?")]
    graph = reports.activity_graph(seen(spark, *given), event_names(spark), at("2 00:00:30"), 1)
    got = [tuple(r) for r in graph.select("bucket_time", "dtime", "wait_class", "cnt").collect()]
    edge = at("1 23:58:30")
    assert got == [
        (edge, "23:58:30", "null", 0.001),
        (edge, "23:58:30", "ON CPU", 0.001),
        (edge, "23:58:30", "User I/O", 0.001),
        (edge, "23:58:30", "System I/O", 0.001),
        (edge, "23:58:30", "Concurrency", 0.001),
        (at("1 23:59:30"), "23:59:30", "null", 0.001),
        (at("1 23:59:45"), "23:59:45", "User I/O", 2.0),
        (at("1 23:59:45"), "23:59:45", "null", 0.001),
        (at("2 00:00:00"), "00:00:00", None, 1 / 15),
        (at("2 00:00:00"), "00:00:00", "ON CPU", 1.0),
        (at("2 00:00:00"), "00:00:00", "null", 0.001),
        (at("2 00:00:15"), "00:00:15", "null", 0.001),
    ]


def test_hot_sql_cut_and_exclusions(either):
    def many(sql_id, n, **values):
        return [sample("1 10:00:00", sql_id=sql_id, **values)] * n

    given = many("c", 3) + many("a", 2) + many("b", 2) + many("0", 9) + many(None, 9) + many("z", 1, inst_id=2) + [sample("1 09:00:00", sql_id="old")] * 9
    df = samples(either, *given)
    assert rows(hot.hot_sql(df, at("1 10:05:00"), n=2), "inst_id", "sql_id", "cnt") == [(1, "a", 2), (1, "c", 3), (2, "z", 1)]
    assert rows(hot.hot_sql(df, at("1 10:05:00"), n=2, target=(1, 1)), "sql_id") == [("a",), ("c",)]


def test_new_objects(either):
    objects = either.createDataFrame([(1, 5, "x"), (2, 5, "y"), (1, 6, "z")], "dbid long, object_id long, object_name string")
    stored = objects.where("dbid = 2")
    df = samples(either, *[sample("1 10:00:00", current_obj=o) for o in (5, 5, 6, -1, -1, -1, 0)])
    assert rows(hot.new_objects(df, objects, stored, at("1 10:30:00")), "dbid", "object_id") == [(1, 5), (1, 6)]
    assert rows(hot.new_objects(df, objects, stored, at("1 10:30:00"), n=1), "dbid", "object_id") == [(1, 5)]


def test_one_text_per_statement(either):
    df = hot.hot_sql(samples(either, sample("1 10:00:00")), at("1 10:00:00"), timedelta(minutes=1))
    text = "dbid long, sql_id string, sql_text string"
    source = either.createDataFrame([(1, "a", "select 2"), (1, "a", "select 1"), (1, "b", "x"), (2, "a", "y")], text)
    assert rows(hot.new_sql_text(df, source, either.createDataFrame([], text))) == [(1, "a", "select 1")]
    assert hot.new_sql_text(df, source, source.where("dbid = 1")).count() == 0
    assert hot.new_sql_text(df, source, source.where("dbid = 2")).count() == 1


def test_missing_counters_are_zero(either):
    df = hot.hot_sql(samples(either, sample("1 10:00:00")), at("1 10:00:00"))
    source = either.createDataFrame(
        [(1, 1, "a", 0, 5), (1, 1, "a", 1, 6), (1, 2, "a", 0, 7)], "dbid long, instance_number long, sql_id string, plan_hash_value long, executions long"
    )
    result = hot.hot_sqlstats(df, source)
    assert rows(result, "plan_hash_value", "executions", "io_disk_bytes", "typecheck_mem") == [(0, 5, 0, 0)]
