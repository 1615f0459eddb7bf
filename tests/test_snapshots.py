"""The snapshot store: visibility, last values, load marks, pruning, expiry."""

from __future__ import annotations

import os
import pathlib
import random
from datetime import datetime, timedelta

import pytest
from conftest import at, event_names, rows, sample, samples
from pyspark.sql import functions as F

from waitlens import jobs, sources, streaming
from waitlens.constants import METRIC_NAMES, SQLSTAT_DELTAS
from waitlens.operators import history, ingest
from waitlens.operators.delta import counter_delta
from waitlens.sources.snapshots import advance, bucketed, write_bucketed

SQLSTATS = "snap_id long, dbid long, instance_number long, sql_id string, plan_hash_value long, " + ", ".join(f"{c} long" for c in SQLSTAT_DELTAS)
REGISTRY = "hist_sample_id long, dbid long, instance_number long, hist_date timestamp"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def registry(spark, snap: int, targets) -> object:
    when = datetime(2024, 1, 1) + timedelta(hours=snap)
    return spark.createDataFrame([(snap, *t, when) for t in targets], REGISTRY)


def counters(pick: random.Random) -> dict[int, list[tuple]]:
    """Six snapshots of two databases with two instances; entities come and go, counters restart, one target skips a snapshot."""
    values, out = {}, {}
    for snap in range(1, 7):
        out[snap] = []
        for target in [(1, 1), (1, 2), (2, 1), (2, 2)]:
            if target == (2, 2) and snap in (3, 4):
                continue
            for sql in "abcde":
                if pick.random() < 0.35:
                    continue
                for n, _ in enumerate(SQLSTAT_DELTAS):
                    key = (*target, sql, n)
                    values[key] = 0 if pick.random() < 0.05 else values.get(key, 0) + pick.randrange(100)
                out[snap].append((snap, *target, sql, 7, *[values[*target, sql, n] for n, _ in enumerate(SQLSTAT_DELTAS)]))
    return out


@pytest.mark.parametrize("on_reset", ["keep", "null"])
def test_last_values_give_the_deltas_of_the_whole_history(spark, tmp_path, on_reset):
    assert len(SQLSTAT_DELTAS) == 26
    by_snap = counters(random.Random(4))
    store, found = sources.SnapshotStore(spark, str(tmp_path)), []
    for snap, given in by_snap.items():
        targets = {r[1:3] for r in given} | {(1, 1)}
        run = store.begin()
        now = spark.createDataFrame(given, SQLSTATS)
        changed, last = advance(now, store.last_values(), registry(spark, snap, targets), SQLSTAT_DELTAS, on_reset=on_reset)
        run.write("sqlstats", changed)
        run.write_last(last, buckets=4)
        run.commit(registry(spark, snap, targets))
    found = store.read("sqlstats")
    history_rows = spark.createDataFrame([r for given in by_snap.values() for r in given], SQLSTATS)
    want = counter_delta(history_rows, snapshots=store.snapshots().withColumnRenamed("hist_sample_id", "snap_id"), on_reset=on_reset)
    columns = ["snap_id", "dbid", "instance_number", "sql_id", "plan_hash_value", *SQLSTAT_DELTAS, *SQLSTAT_DELTAS.values()]
    assert rows(found, *columns) == rows(want, *columns)
    changes = found.where(f"{next(iter(SQLSTAT_DELTAS.values()))} is not null").count()
    assert 0 < changes < found.count()
    kept = rows(store.last_values())
    assert len(store.expire(datetime(2000, 1, 1), ["sqlstats"])) == len(by_snap) - 1 and rows(store.last_values()) == kept


def test_only_new_rows_move(shuffled, tmp_path):
    """Too big to be broadcast, the stored side is read in its buckets: the plan's one shuffle is that of the new rows."""
    spark = shuffled
    given = spark.createDataFrame(counters(random.Random(1))[1], SQLSTATS)
    write_bucketed(given, str(tmp_path / "last"), ["dbid", "instance_number", "sql_id", "plan_hash_value"], 4)
    last = bucketed(spark, str(tmp_path / "last"), 4)
    changed, _ = advance(given.withColumn("snap_id", F.lit(2).cast("long")), last, registry(spark, 2, [(1, 1)]), SQLSTAT_DELTAS)
    plan = plan_text(changed)
    assert plan.count("Exchange") == 1, plan
    scan = plan[: plan.index("FileScan parquet")]
    assert "Bucketed: true" in plan and "Exchange" not in scan[scan.rindex("Sort [") :], plan
    assert len([f for f in os.listdir(tmp_path / "last") if f.endswith(".parquet")]) <= 4


def test_a_broken_run_shows_nothing(spark, tmp_path):
    store = sources.SnapshotStore(spark, str(tmp_path))
    first = store.begin()
    first.write("iofuncstats", spark.sql("select 1L snap_id, 1L dbid, 1L instance_number, 5L function_id"))
    first.commit(registry(spark, 1, [(1, 1)]))
    broken = store.begin()
    broken.write("iofuncstats", spark.sql("select 2L snap_id, 1L dbid, 1L instance_number, 6L function_id"))
    broken.write("metrics", spark.sql("select 2L snap_id, 1L dbid, 1L inst_id, timestamp'2024-01-01 05:00:00' begin_time"), mark="begin_time")
    assert rows(store.read("iofuncstats"), "snap_id", "function_id") == [(1, 5)]
    assert store.marks("metrics").isEmpty() and store.snapshots().count() == 1
    again = store.begin("hour-2")
    again.write("iofuncstats", spark.sql("select 2L snap_id, 1L dbid, 1L instance_number, 7L function_id"))
    again.commit(registry(spark, 2, [(1, 1)]))
    assert rows(store.read("iofuncstats"), "snap_id", "function_id") == [(1, 5), (2, 7)]
    assert rows(store.latest("iofuncstats"), "snap_id", "function_id") == [(2, 7)]
    assert rows(store.latest("iofuncstats", as_of=datetime(2024, 1, 1, 1)), "function_id") == [(5,)]
    with pytest.raises(ValueError):
        store.begin("hour-2")
    # folders of runs that were never committed go with the expired ones
    dropped = store.expire(datetime(2024, 1, 1, 2), ["iofuncstats", "metrics"])
    assert len(dropped) == 3 and not any(os.path.exists(f.removeprefix("file:")) for f in dropped)
    assert rows(store.read("iofuncstats"), "snap_id", "function_id") == [(2, 7)]


def test_latest_is_by_target(spark, tmp_path):
    store = sources.SnapshotStore(spark, str(tmp_path))
    for snap, targets in ((1, [(1, 1), (2, 1)]), (2, [(1, 1)])):
        run = store.begin()
        run.write("sqlstats", spark.createDataFrame([(snap, *t, "q") for t in [(1, 1), (2, 1)]], "snap_id long, dbid long, instance_number long, sql_id string"))
        run.commit(registry(spark, snap, targets))
    assert rows(store.latest("sqlstats"), "snap_id", "dbid") == [(1, 2), (2, 1)]
    assert rows(store.latest("sqlstats", target=(2, 1)), "snap_id", "dbid") == [(1, 2)]


@pytest.fixture
def filled(spark, tmp_path):
    store = sources.SnapshotStore(spark, str(tmp_path))
    run = store.begin()
    given = spark.range(400).selectExpr(
        "id div 20 + 1 as snap_id", "1 + id % 2 as dbid", "1L as inst_id", "timestamp'2024-01-01' + make_dt_interval(0, int(id div 20), 30) as begin_time",
        "id % 5 as metric_id", "double(id) as value",
    )
    run.write("metrics", given, mark="begin_time")
    targets = spark.sql("select dbid, 1L as instance_number from values (1L), (2L) as v(dbid)")
    snaps = spark.range(1, 21).selectExpr("id as hist_sample_id", "timestamp'2024-01-01' + make_dt_interval(0, int(id)) as hist_date")
    run.commit(snaps.crossJoin(targets))
    return store


def test_reads_are_pruned_by_the_registry(spark, filled):
    some = filled.read("metrics", datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 7))
    assert "dynamicpruning" in plan_text(some)
    assert {r[0] for r in some.select("snap_id").collect()} == {5, 6, 7}
    assert "dynamicpruning" in plan_text(filled.latest("metrics"))
    assert filled.read("metrics", target=(2, 1)).count() == 200
    # files of other snapshots are not even opened
    for file in pathlib.Path(filled.path).glob("data/metrics/run=*/snap_id=*/*.parquet"):
        if file.parent.name not in ("snap_id=5", "snap_id=6", "snap_id=7"):
            file.write_bytes(b"no parquet")
    again = sources.SnapshotStore(spark, filled.path, {"metrics": some.schema}).read("metrics", datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 7))
    assert again.count() == 60


def test_marks_replace_the_loaded_history(spark, filled):
    names = spark.sql("select explode(array(1L, 2L)) as dbid, id as metric_id from range(5)")
    source = spark.sql(
        "select 1 + id % 2 as dbid, 1L as inst_id, timestamp'2024-01-01' + make_dt_interval(0, int(id)) as begin_time, 6000L as intsize_csec,"
        " id % 5 as metric_id, 1d as value from range(40) union all"
        " select 3L, 1L, timestamp'2023-11-01', 6000L, 1L, 1d union all select 1L, 2L, timestamp'2024-01-01', 6000L, 1L, 1d"
    )
    marked = ingest.metric_increment(source, None, names, datetime(2024, 1, 2), marks=filled.marks("metrics"))
    scanned = ingest.metric_increment(source, filled.read("metrics"), names, datetime(2024, 1, 2))
    assert rows(marked) == rows(scanned)
    assert all("/commits/" in file for file in marked.inputFiles()) and any("/data/metrics/" in file for file in scanned.inputFiles())
    assert (1, 2) in rows(marked, "dbid", "inst_id")  # a first load


def test_streamed_metrics_move_the_mark(spark, tmp_path):
    store = sources.SnapshotStore(spark, str(tmp_path / "store"))
    names = spark.sql("select 1L as dbid, id as metric_id from range(5)")
    schema = "dbid long, inst_id long, begin_time timestamp, intsize_csec long, metric_id long, value double"
    for part, hours in enumerate([range(0, 4), range(2, 8)]):
        given = [(1, 1, datetime(2024, 1, 1, h), 6000, h % 5, float(h)) for h in hours]
        spark.createDataFrame(given, schema).write.parquet(str(tmp_path / "in" / str(part)))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        streaming.ingest_metrics(stream, store, names, datetime(2024, 1, 2), str(tmp_path / "check")).awaitTermination()
    assert rows(store.read("metric_history"), "begin_time") == [(datetime(2024, 1, 1, h),) for h in range(8)]
    assert rows(store.marks("metric_history"), "mark") == [(datetime(2024, 1, 1, 7),)]


def test_history_by_snapshot_reads_the_days_of_the_snapshots(spark, tmp_path):
    given = samples(spark, *[sample(f"{d} 12:00:10", session_id=d) for d in range(1, 11)])
    sources.write_samples(given, str(tmp_path / "samples"))
    store = sources.SnapshotStore(spark, str(tmp_path / "store"))
    run = store.begin()
    run.commit(spark.createDataFrame([(1, 1, 1, at("3 00:00:00")), (2, 1, 1, at("5 00:00:00"))], REGISTRY))
    seen = history.session_history(sources.read_samples(spark, str(tmp_path / "samples")), event_names(spark))
    found = history.sampled_by_snapshot(seen, store.snapshots(), 1440)
    assert rows(found, "snap_id", "session_id") == [(1, 3), (2, 5)]
    plan = plan_text(found)
    assert "dynamicpruning" in plan and "sample_date" in plan[plan.index("dynamicpruning") - 200 : plan.index("dynamicpruning") + 200]


def test_whole_runs(spark, tmp_path):
    """Two runs of the snapshot job, and a broken one between; state comes from the store alone."""
    store = sources.SnapshotStore(spark, str(tmp_path))
    names = METRIC_NAMES[0]

    def hosts(snap: int) -> dict:
        return {
            "users": spark.createDataFrame([(1, u, f"u{u}") for u in range(snap + 2)], "dbid long, user_id long, username string"),
            "sqlstats": spark.createDataFrame([(1, 1, "a", 0, 10 * snap, 3 * snap)], "dbid long, instance_number long, sql_id string, plan_hash_value long, executions long, elapsed_time long"),
            "metric_history": spark.createDataFrame(
                [(1, 1, datetime(2024, 1, 1, h), 6000, 2, 1, 1.0) for h in range(snap * 3)],
                "dbid long, inst_id long, begin_time timestamp, intsize_csec long, group_id long, metric_id long, value double",
            ),
            "time_model": spark.createDataFrame([(1, 1, 4, 100 * snap)], "dbid long, inst_id long, stat_id long, value long"),
        }

    def stored(snap: int) -> dict:
        users = store.read("users").drop("snap_id") if snap > 1 else spark.createDataFrame([], "dbid long, user_id long, username string")
        return {
            "samples": samples(spark, *[sample("1 09:59:00") for _ in range(3)]),
            "users": users,
            "metric_names": spark.createDataFrame([(1, 1, names, "x")], "dbid long, metric_id long, metric_name string, metric_unit string"),
            "targets": spark.createDataFrame([(1, 1)], "dbid long, inst_num long"),
        }

    def run(snap: int) -> str:
        return jobs.run_snapshot(store, hosts(snap), stored(snap), snap, at("1 10:00:00"), columns=["executions", "elapsed_time"])

    run(1)
    broken = store.begin()
    broken.write("users", hosts(5)["users"].withColumn("snap_id", F.lit(9).cast("long")))
    run(2)
    assert rows(store.read("users"), "snap_id", "user_id") == [(1, 0), (1, 1), (1, 2), (2, 3)]
    assert rows(store.read("sqlstats"), "snap_id", "executions", "executions_delta") == [(1, 10, None), (2, 20, 10)]
    assert rows(store.read("metric_history"), "snap_id", "begin_time") == [(1 if h < 3 else 2, datetime(2024, 1, 1, h)) for h in range(6)]
    assert rows(store.read("time_model"), "snap_id", "value") == [(1, 100), (2, 200)]
    assert rows(store.snapshots(), "hist_sample_id") == [(1,), (2,)]


def test_commits_are_compacted(spark, tmp_path):
    """The same registry, marks and rows from one file, and from a file beside old ones that a failure left."""
    store = sources.SnapshotStore(spark, str(tmp_path))
    for snap in range(1, 6):
        run = store.begin()
        run.write("m", spark.sql(f"select {snap}L snap_id, 1L dbid, 1L inst_id, timestamp'2024-01-01 0{snap}:00:00' begin_time"), mark="begin_time")
        run.commit(registry(spark, snap, [(1, 1)]))
    files = list(pathlib.Path(tmp_path).glob("commits/*.parquet"))
    before = [rows(store.snapshots()), rows(store.marks("m")), rows(store.read("m")), rows(store.latest("m"))]
    kept = {f: f.read_bytes() for f in files[:2]}
    assert store.compact_commits() == len(files) == 5
    for _ in range(2):
        assert [rows(store.snapshots()), rows(store.marks("m")), rows(store.read("m")), rows(store.latest("m"))] == before
        for file, data in kept.items():
            file.write_bytes(data)
    assert store._next() == 6
