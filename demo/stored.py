"""Registered queries on stored tables: the snapshot store, its state and pruned reads, deletes, merges, and job contents."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demo import registry as r
from demo.fixtures import Tables
from waitlens import plans, sources, streaming
from waitlens.constants import SQLSTAT_DELTAS
from waitlens.operators import delta, dims, history, ingest, times
from waitlens.views import build_views, stored_tables

query = r.query
LAST_BASE = 2001 * 12 + 5
METRIC_RUNS = (datetime(1998, 2, 1), datetime(1999, 1, 1), datetime(2002, 1, 1))
FILES_AS_OF = datetime(2024, 1, 30, 12)


def _month_end(df: DataFrame) -> DataFrame:
    """Snapshots numbered by month are taken when it ends."""
    month = "make_timestamp((hist_sample_id - 1) div 12, (hist_sample_id - 1) % 12 + 1, 1, 0, 0, 0)"
    return df.withColumn("hist_date", F.expr(f"{month} + make_ym_interval(0, 1)"))


def _registered(rows: DataFrame, inst: str) -> DataFrame:
    return _month_end(ingest.register_snapshots(rows, inst_col=inst))


_STORES: dict[tuple, sources.SnapshotStore] = {}


def _once(t: Tables, name: str, fill: Callable[[sources.SnapshotStore], None]) -> sources.SnapshotStore:
    """A store that is filled once a session and input folder."""
    key = (t.spark.sparkContext.applicationId, t.dir, name)
    if key not in _STORES:
        store = sources.SnapshotStore(t.spark, sources.work_folder(t.spark))
        fill(store)
        _STORES[key] = store
    return _STORES[key]


def _one_run(t: Tables, name: str, rows: DataFrame, inst: str) -> sources.SnapshotStore:
    def fill(store: sources.SnapshotStore) -> None:
        run = store.begin()
        run.commit(_registered(run.write(name, rows), inst))

    return _once(t, name, fill)


# reads pruned by the registry


@query
def stored_latest_sqlstats(t: Tables) -> DataFrame:
    return _one_run(t, "sqlstats", t.sqlstats(), "instance_number").latest("sqlstats")


@query
def stored_metric_recent(t: Tables) -> DataFrame:
    store = _one_run(t, "metric_history", t.metric_history(), "inst_id")
    rows = store.read("metric_history", start=r.METRIC_AS_OF - r.MONTH, target=(1, 1))
    return times.recent(history.metric_history(rows, t.metric_names()), r.METRIC_AS_OF, r.MONTH, "begin_time")


@query
def stored_history_by_snapshot(t: Tables) -> DataFrame:
    def fill(store: sources.SnapshotStore) -> None:
        sources.write_samples(t.samples(), f"{store.path}/samples")
        store.begin().commit(t.snapshots())

    store = _once(t, "samples", fill)
    seen = history.session_history(sources.read_samples(t.spark, f"{store.path}/samples"), t.event_names())
    return history.sampled_by_snapshot(seen, store.snapshots(), r.DAY_MINUTES).drop("sample_date")


# state: last values and load marks


def _increments(t: Tables) -> sources.SnapshotStore:
    """The history up to a month in one run, then a run for each later month, with deltas from the last values alone."""

    def fill(store: sources.SnapshotStore) -> None:
        rows = t.sqlstats_wide()
        base = rows.where(F.col("snap_id") <= LAST_BASE)
        run = store.begin()
        written = run.write("sqlstats", delta.counter_delta(base, columns=SQLSTAT_DELTAS))
        registry = _registered(written, "instance_number")
        run.write_last(history.latest_snapshot(base, registry), buckets=8)
        run.commit(registry)
        later = rows.where(F.col("snap_id") > LAST_BASE).select("snap_id").distinct().orderBy("snap_id")
        for (snap,) in later.collect():
            run, now = store.begin(), rows.where(F.col("snap_id") == snap)
            registry = _registered(now, "instance_number")
            changed, last = sources.advance(now, store.last_values(), registry, SQLSTAT_DELTAS)
            run.write("sqlstats", changed)
            run.write_last(last, buckets=8)
            run.commit(registry)

    return _once(t, "increments", fill)


@query
def sqlstat_increments(t: Tables) -> DataFrame:
    return _increments(t).read("sqlstats")


def _metric_runs(t: Tables) -> sources.SnapshotStore:
    """Three loads, the first of nothing loaded yet; how far the targets are loaded comes from the commits. One breaks off."""

    def fill(store: sources.SnapshotStore) -> None:
        source = t.metric_history().drop("snap_id")
        for number, as_of in enumerate(METRIC_RUNS, 1):
            there = source.where(F.col("begin_time") < F.lit(as_of.isoformat(sep=" ")).cast("timestamp"))
            new = ingest.metric_increment(there, None, t.metric_names(), as_of, marks=store.marks("metric_history"))
            stamped = ingest.snapshot_stamp(new, number)
            store.begin().write("metric_history", stamped.limit(10), mark="begin_time")  # breaks off before its commit
            run = store.begin()
            run.write("metric_history", stamped, mark="begin_time")
            targets = t.targets().select(F.lit(number).alias("hist_sample_id"), "dbid", F.col("inst_num").alias("instance_number"))
            run.commit(targets.withColumn("hist_date", F.lit(as_of.isoformat(sep=" ")).cast("timestamp")))

    return _once(t, "metric_runs", fill)


@query
def metric_runs(t: Tables) -> DataFrame:
    return _metric_runs(t).read("metric_history")


@query
def metric_marks(t: Tables) -> DataFrame:
    return _metric_runs(t).marks("metric_history")


# deletes and merges in the files


@query
def delete_expired_hours(t: Tables) -> DataFrame:
    path = f"{sources.work_folder(t.spark)}/samples"
    sources.write_samples(t.samples(), path)
    sources.delete_expired(t.spark, path, "h", FILES_AS_OF)
    return t.spark.read.parquet(path).withColumn("dbid", F.col("dbid").cast("bigint"))


@query
def expire_snapshot_files(t: Tables) -> DataFrame:
    store = sources.SnapshotStore(t.spark, sources.work_folder(t.spark))
    run = store.begin()
    run.write("event_histogram", t.event_histogram())
    run.commit(t.snapshots())
    store.expire(r.AS_OF - timedelta(days=8), ["event_histogram"])
    files = t.spark.read.parquet(f"{store.path}/data/event_histogram")
    return files.withColumn("snap_id", F.col("snap_id").cast("bigint")).drop("run")


@query
def dim_merge_buckets(t: Tables) -> DataFrame:
    path = f"{sources.work_folder(t.spark)}/users"
    renamed = t.customers(r.RENAMED_USERS).withColumn("username", F.concat("username", F.lit("*")))
    for rows in (t.users(), renamed, renamed):
        sources.merge_buckets(rows, path, ["dbid", "user_id"], ["username"], 8)
    return t.spark.read.parquet(path).drop("bucket")


# moments


@query
def metric_summary_from_moments(t: Tables) -> DataFrame:
    """Moments by day are stored, and those of a snapshot merged from them."""
    daily = history.metric_moments(t.metric_history().withColumn("day", F.to_date("begin_time")), ["snap_id", "day"])
    merged = history.summary_of_moments(sources.materialise(daily), t.metric_names())
    return merged.withColumns({c: F.round(c, 6) for c in ("average", "standard_deviation")})


@query
def metric_summary_by_year(t: Tables) -> DataFrame:
    kept = sources.materialise(history.metric_moments(t.metric_history()))
    yearly = kept.withColumn("year", F.expr("(snap_id - 1) div 12"))
    merged = history.summary_of_moments(yearly, t.metric_names(), ["year"])
    return merged.withColumns({c: F.round(c, 6) for c in ("average", "standard_deviation")})


# windows of a stream, compacted


@query
def stream_activity_compacted(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    part = F.pmod(F.xxhash64("session_id", "sample_time"), F.lit(3))
    for number in range(3):
        t.samples().where(part == number).write.parquet(f"{path}/in/{number}")
    files = len(sources.folders(t.spark, f"{path}/in/*/*.parquet"))  # as many as tasks wrote; three batches however many they are
    stream = streaming.read_sample_stream(t.spark, f"{path}/in/*", t.samples().schema, max_files=max(1, -(-files // 3)))
    activity = streaming.activity_by_window(streaming.enrich(stream, t.event_names()), 3600, "60 days")
    streaming.write_windows(activity, f"{path}/activity", f"{path}/checkpoint").awaitTermination()
    for before in (datetime(2024, 1, 10), datetime(2024, 1, 20)):
        streaming.compact_windows(t.spark, f"{path}/activity", ["wait_class"], before)
    return streaming.read_windows(t.spark, f"{path}/activity", ["wait_class"])


# contents of the jobs' outputs


def _output(name: str) -> None:
    def body(t: Tables) -> DataFrame:
        more = {"instance_stats": t.instance_stats(), "osstat": t.osstat().drop("snap_id")}
        return r._snapshot_outputs(t, more, {"stat_names": t.stat_names()})[name]

    body.__name__ = f"snapshot_of_{name}"
    query(body)


for _name in (
    "users", "data_files", "sqltext", "sqlstats", "plan_lines", "objects", "metric_history", "io_events", "instance_stats",
    "event_histogram", "time_model", "osstat", "iofuncstats", "snapshots",
):
    _output(_name)


def _load(name: str) -> None:
    def body(t: Tables) -> DataFrame:
        more = {"latches": t.latches(), "osstat_names": t.osstat_names(), "params": t.params(), "metric_names": _host_metric_names(t)}
        known = {n: more[n].where(F.col("dbid") == 1) for n in more}
        return r._dimension_loads(t, more, known)[name]

    body.__name__ = f"load_of_{name}"
    query(body)


def _host_metric_names(t: Tables) -> DataFrame:
    """The region names, and the first of the names that are kept, twice."""
    kept = F.lit("User Transaction Per Sec").alias("metric_name")
    wanted = t.metric_names().where("metric_id = 0").select("dbid", "metric_id", kept, "metric_unit")
    return t.metric_names().unionByName(wanted).unionByName(wanted)


for _name in (
    "event_names", "users", "stat_names", "time_model_names", "extents", "data_files", "latches", "osstat_names", "params", "metric_names",
):
    _load(_name)


# views and names that no other row has


@query
def osstat_named(t: Tables) -> DataFrame:
    return history.time_model(t.osstat(), t.osstat_names(), key="osstat_id")


@query
def wait_groups_file(t: Tables) -> DataFrame:
    path = f"{sources.work_folder(t.spark)}/groups"
    t.wait_groups().write.csv(path, header=True)
    return dims.apply_wait_groups(t.event_names(), sources.read_wait_groups(t.spark, path))


@query
def active_session_filter_wide_blockers(t: Tables) -> DataFrame:
    """Mode v19 with its own layout: 18 bits for the session."""
    return ingest.active_sessions(t.raw_sessions(), t.event_names(), "v19", exclude_session=3)


@query
def sqlstat_history_fleet(t: Tables) -> DataFrame:
    return history.sqlstat_history(t.sqlstats_wide())


def _view(view: str, table: str) -> None:
    def body(t: Tables) -> DataFrame:
        return build_views({table: getattr(t, table)()}, target=(2, 1))[view]

    body.__name__ = f"view_{view.removeprefix('v$')}"
    query(body)


for _name, _table in {
    "v$parameter": "params", "dba_users": "users", "dba_data_files": "data_files", "all_objects": "objects", "v$sql": "sqltext",
    "v$sqltext_with_newlines": "sqltext", "v$sql_plan": "plan_lines",
}.items():
    _view(_name, _table)


def _of_target(view: str, tables: Callable[[Tables], dict[str, DataFrame]], target: tuple[int, int]) -> None:
    def body(t: Tables) -> DataFrame:
        return build_views(tables(t), target)[view]

    body.__name__ = f"view_{view.removeprefix('v$')}"
    query(body)


def _stored_sqlstats(t: Tables) -> dict[str, DataFrame]:
    return stored_tables(_increments(t), ["sqlstats"], target=(2, 1))


def _targets(t: Tables) -> dict[str, DataFrame]:
    named = {"sid": F.concat("dbname", F.lit("_"), F.col("inst_num").cast("string")), "version": F.lit("19")}
    return {"targets": t.targets().withColumns(named)}


_of_target("v$sqlstats", _stored_sqlstats, (2, 1))
_of_target("v$iostat_function", lambda t: {"iofuncstats": t.iofuncstats(), "snapshots": t.snapshots()}, (2, 1))
_of_target("v$instance", _targets, (2, 2))
_of_target("v$database", _targets, (2, 2))


# plans that databases share, from SQL, and without depth


def _shared_lines(t: Tables) -> DataFrame:
    """Every plan under one hash value, so that each statement's is stored for several databases with other operations."""
    lines = t.plan_lines().withColumn("plan_hash_value", F.lit(5).cast("bigint"))
    return lines.withColumn("operation", F.concat("operation", F.lit("_"), F.col("dbid").cast("string")))


def _shared_sql(lines: DataFrame) -> DataFrame:
    """One statement's number for the lines of several."""
    return lines.withColumn("sql_id", F.when(F.col("sql_id").isin("q7", "q8", "q9"), "q7").otherwise(F.col("sql_id")))


@query
def plan_render_shared(t: Tables) -> DataFrame:
    return plans.render(_shared_sql(_shared_lines(t)), t.sqltext(), r.SQL_ID)


@query
def plan_render_first_shared(t: Tables) -> DataFrame:
    return plans.render_first(_shared_sql(_shared_lines(t)), r.SQL_ID)


@query
def plan_display_sql(t: Tables) -> DataFrame:
    """The plan text as a table function in SQL."""
    plans.register_functions(_shared_sql(t.plan_lines()), t.sqltext())
    return t.spark.sql("select 'all' as called, * from display('q7') union all select 'one', * from display('q7', 1)"
                       " union all select 'first', * from display_plan('q7')")  # fmt: skip


@query
def plan_tree(t: Tables) -> DataFrame:
    return plans.with_tree(t.plan_lines().drop("depth"))
