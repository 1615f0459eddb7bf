"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demo.fixtures import Tables
from waitlens import jobs, plans, sources, streaming
from waitlens.operators import delta, dims, history, hot, ingest, quality, reports, retention, times
from waitlens.views import register_views

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 31)
GRAPH_AS_OF = datetime(2024, 1, 30)
METRIC_AS_OF = datetime(2001, 11, 5)
METRIC_LOADED = datetime(2000, 1, 1)
TOP_START, TOP_STOP = datetime(2024, 1, 8), datetime(2024, 1, 22)
WEEK, MONTH = timedelta(days=7), timedelta(days=30)
SESSION, EVENT, SQL_ID = 7, "NATION_0", "q7"
DAY_MINUTES = 1440
COUNTERS = ("executions", "elapsed_time")

_QUERIES: dict[str, Query] = {}


def query(body: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return body(Tables(spark, sf_dir))

    _QUERIES[body.__name__] = run
    return body


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _history(t: Tables, as_of: datetime | None = None, span: timedelta | None = None, **options) -> DataFrame:
    since = None if as_of is None or span is None else as_of - span
    return history.session_history(t.samples(since, as_of), t.event_names(), **options)


# session history and reports


@query
def session_history(t: Tables) -> DataFrame:
    return _history(t)


@query
def top_sql_by_wait_class(t: Tables) -> DataFrame:
    return reports.top_sql_by_wait_class(t.samples(TOP_START, TOP_STOP), TOP_START, TOP_STOP, event_names=t.event_names())


@query
def db_time_by_sql(t: Tables) -> DataFrame:
    return reports.db_time_by_sql(t.samples(AS_OF - WEEK, AS_OF), AS_OF, WEEK, "hour", t.event_names())


@query
def event_rows(t: Tables) -> DataFrame:
    return reports.event_rows(_history(t, AS_OF, WEEK), EVENT, AS_OF, WEEK)


@query
def event_details(t: Tables) -> DataFrame:
    return reports.event_details(_history(t, AS_OF, WEEK), EVENT, AS_OF, WEEK)


@query
def top_sessions(t: Tables) -> DataFrame:
    return reports.top_sessions(_history(t, AS_OF, WEEK), AS_OF, WEEK)


@query
def session_details(t: Tables) -> DataFrame:
    return reports.session_details(_history(t, AS_OF, MONTH), SESSION, AS_OF, MONTH)


@query
def session_sqls(t: Tables) -> DataFrame:
    return reports.session_sqls(_history(t, AS_OF, MONTH), SESSION, AS_OF, MONTH)


@query
def session_events(t: Tables) -> DataFrame:
    return reports.session_events(_history(t, AS_OF, MONTH), SESSION, AS_OF, MONTH)


@query
def session_sql_events(t: Tables) -> DataFrame:
    return reports.session_sql_events(_history(t, AS_OF, MONTH), SESSION, AS_OF, MONTH)


@query
def activity_graph(t: Tables) -> DataFrame:
    rows = t.samples(GRAPH_AS_OF - timedelta(minutes=DAY_MINUTES), GRAPH_AS_OF)
    return reports.activity_graph(rows, t.event_names(), GRAPH_AS_OF, DAY_MINUTES, 900, stored=True)


# snapshots of counters and metrics


@query
def counter_delta(t: Tables) -> DataFrame:
    return delta.counter_delta(t.sqlstats(), columns=COUNTERS)


@query
def sqlstat_history(t: Tables) -> DataFrame:
    return history.sqlstat_history(t.sqlstats(), dbid=1, columns=COUNTERS)


@query
def latest_sqlstats(t: Tables) -> DataFrame:
    return history.latest_snapshot(t.sqlstats(), t.sqlstat_snapshots())


@query
def sqlstats_for_sql(t: Tables) -> DataFrame:
    return reports.sqlstats_for_sql(history.latest_snapshot(t.sqlstats(), t.sqlstat_snapshots()), SQL_ID)


@query
def latest_iostat(t: Tables) -> DataFrame:
    return history.latest_snapshot(t.iofuncstats(), t.snapshots(), salt_on=["function_id"])


@query
def snapshot_stamp(t: Tables) -> DataFrame:
    rows = t.event_histogram().groupBy("dbid", "inst_id", "event_no", "wait_time_milli").agg(F.sum("wait_count").alias("wait_count"))
    return ingest.snapshot_stamp(rows, 32)


@query
def io_event_snapshot(t: Tables) -> DataFrame:
    return ingest.io_event_snapshot(t.system_events(), 32)


@query
def flagged_stat_snapshot(t: Tables) -> DataFrame:
    return ingest.flagged_stats(t.instance_stats(), t.stat_names())


@query
def metric_incremental(t: Tables) -> DataFrame:
    metrics = t.metric_history()
    loaded = metrics.where(F.col("begin_time") < F.lit(METRIC_LOADED.isoformat(sep=" ")).cast("timestamp"))
    return ingest.metric_increment(metrics, loaded, t.metric_names(), METRIC_AS_OF)


@query
def snapshot_register(t: Tables) -> DataFrame:
    return ingest.register_snapshots(t.metric_history(), "begin_time")


@query
def snapshot_list(t: Tables) -> DataFrame:
    return history.snapshot_list(t.snapshots())


@query
def metric_history(t: Tables) -> DataFrame:
    return history.metric_history(t.metric_history(), t.metric_names())


@query
def metric_recent(t: Tables) -> DataFrame:
    named = history.metric_history(t.metric_history(), t.metric_names(), target=(1, 1))
    return times.recent(named, METRIC_AS_OF, MONTH, "begin_time")


@query
def metric_summary(t: Tables) -> DataFrame:
    summary = history.metric_summary(t.metric_history(), t.metric_names())
    rounded = {c: F.round(c, 6) for c in ("average", "standard_deviation")}
    return summary.withColumns(rounded)


@query
def event_histogram_named(t: Tables) -> DataFrame:
    return history.event_histogram(t.event_histogram(), t.event_names())


@query
def time_model_named(t: Tables) -> DataFrame:
    return history.time_model(t.time_model(), t.time_model_names())


# range joins


@query
def history_by_snapshot(t: Tables) -> DataFrame:
    return history.sampled_by_snapshot(_history(t), t.snapshots(), DAY_MINUTES)


@query
def block_to_segment(t: Tables) -> DataFrame:
    rows = dims.block_to_segment(t.samples(), t.extents(), ["segment_name", "segment_type"], width=64)
    return rows.select("dbid", "inst_id", "sample_id", "session_id", "current_file", "current_block", "segment_name", "segment_type")


# ingest


@query
def active_session_filter(t: Tables) -> DataFrame:
    return ingest.active_sessions(t.raw_sessions(), t.event_names(), "v19", exclude_session=3, layout=16)


@query
def active_session_filter_v10(t: Tables) -> DataFrame:
    return ingest.active_sessions(t.raw_sessions(), t.event_names(), "v10", exclude_session=3)


@query
def active_session_filter_v9(t: Tables) -> DataFrame:
    # two names of the fixed idle list stand in for two nations, so that the list matches something
    renamed = F.when(F.col("event_no") == 4, "PMON timer").when(F.col("event_no") == 9, "Null event").otherwise(F.col("name"))
    names = t.event_names().withColumn("name", renamed)
    return ingest.active_sessions(t.raw_sessions(), names, "v9", exclude_session=3)


@query
def blocker_decode(t: Tables) -> DataFrame:
    rows = t.samples().select("sample_id", "session_id", "ksuseblocker")
    return ingest.decode_blocker(rows, "ksuseblocker", 16)


@query
def stamp_samples(t: Tables) -> DataFrame:
    columns = ("dbid", "inst_id", "sample_time", "session_id", "session_state", "event_no", "sql_id")
    return ingest.stamp_samples(t.samples().select(*columns))


NEW_USERS, RENAMED_USERS = "c_acctbal < 0", "c_mktsegment = 'BUILDING'"
STORED_FILES = "s_acctbal >= 5000"


@query
def dim_append_new(t: Tables) -> DataFrame:
    return ingest.append_new(t.customers(), t.users(), ["dbid", "user_id"])


@query
def dim_append_strict(t: Tables) -> DataFrame:
    return ingest.append_strict(t.customers(NEW_USERS), t.users(), ["dbid", "user_id"])


@query
def dim_append_strict_clash(t: Tables) -> DataFrame:
    return ingest.append_strict(t.customers(), t.users(), ["dbid", "user_id"])


@query
def dim_upsert(t: Tables) -> DataFrame:
    renamed = t.customers(RENAMED_USERS).withColumn("username", F.concat("username", F.lit("*")))
    return ingest.upsert(t.users(), renamed, ["dbid", "user_id"], ["username"])


@query
def metric_name_filter(t: Tables) -> DataFrame:
    named = history.metric_history(t.metric_history(), t.metric_names())
    source = named.select("dbid", "metric_id", "metric_name", "metric_unit")
    return ingest.select_names(source, ["AFRICA", "ASIA", "EUROPE"])


@query
def wait_class_remap(t: Tables) -> DataFrame:
    return dims.apply_wait_groups(t.event_names(), t.wait_groups())


# hot sets


@query
def hot_sql(t: Tables) -> DataFrame:
    return hot.hot_sql(t.samples(AS_OF - WEEK, AS_OF), AS_OF, WEEK)


@query
def hot_sql_target(t: Tables) -> DataFrame:
    return hot.hot_sql(t.samples(AS_OF - WEEK, AS_OF), AS_OF, WEEK, target=(1, 1))


def _hot(t: Tables) -> DataFrame:
    return hot.hot_sql(t.samples(AS_OF - WEEK, AS_OF), AS_OF, WEEK)


@query
def sql_variants(t: Tables) -> DataFrame:
    return hot.sql_variants(t.samples(), SQL_ID)


@query
def hot_objects_new(t: Tables) -> DataFrame:
    stored = t.objects().where(F.col("dbid") == 2)
    return hot.new_objects(t.samples(AS_OF - MONTH, AS_OF), t.objects(), stored, AS_OF, MONTH)


@query
def sql_text_new(t: Tables) -> DataFrame:
    return hot.new_sql_text(_hot(t), t.sqltext_by_plan(), t.sqltext().where(F.col("dbid") == 1))


@query
def plan_lines_new(t: Tables) -> DataFrame:
    return hot.new_plan_lines(_hot(t), t.plan_lines(), t.plan_lines().where(F.col("inst_id") == 1))


@query
def sqlstats_hot(t: Tables) -> DataFrame:
    return hot.hot_sqlstats(_hot(t), t.sqlstats(), (*COUNTERS, "cpu_time"))


def _one_sql(t: Tables) -> dict[str, DataFrame]:
    stats = t.sqlstats()
    last = 2001 * 12 + 6
    source = stats.where(F.col("snap_id") == last)
    return jobs.snapshot_one(
        {"sqltext": t.sqltext_by_plan(), "sqlstats": source, "plan_lines": t.plan_lines()},
        {
            "samples": t.samples(),
            "sqltext": t.sqltext().where(F.col("dbid") == 1),
            "sqlstats": stats.where(F.col("snap_id") < last),
            "plan_lines": t.plan_lines().where(F.col("inst_id") == 1),
        },
        SQL_ID,
        last,
        AS_OF,
        columns=COUNTERS,
    )


@query
def snapshot_one_sql(t: Tables) -> DataFrame:
    return _one_sql(t)["sqlstats"]


@query
def snapshot_one_plan_lines(t: Tables) -> DataFrame:
    return _one_sql(t)["plan_lines"]


# dimensions and stored plans


@query
def dim_for_target(t: Tables) -> DataFrame:
    return dims.for_target(t.customers(), 1)


@query
def sql_text_for_sql(t: Tables) -> DataFrame:
    return dims.sql_text(t.sqltext(), SQL_ID)


@query
def plan_rows(t: Tables) -> DataFrame:
    return plans.plan_rows(t.plan_lines(), 1)


@query
def plan_table(t: Tables) -> DataFrame:
    return plans.plan_table(t.plan_lines())


@query
def plan_render(t: Tables) -> DataFrame:
    return plans.render(t.plan_lines(), t.sqltext(), SQL_ID)


@query
def plan_render_one(t: Tables) -> DataFrame:
    return plans.render(t.plan_lines(), t.sqltext(), SQL_ID, plan=1)


@query
def plan_render_first(t: Tables) -> DataFrame:
    return plans.render_first(t.plan_lines(), SQL_ID)


# store and retention


@query
def partitioned_roundtrip(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    sources.write_samples(t.samples(), path)
    return sources.read_samples(t.spark, path, TOP_START, TOP_STOP)


@query
def retention_expire(t: Tables) -> DataFrame:
    return retention.expire(t.samples(), "d", AS_OF)


@query
def retention_by_snapshot(t: Tables) -> DataFrame:
    return retention.expire_by_snapshot(t.event_histogram(), t.snapshots(), "d", AS_OF, salt_on=["event_no", "wait_time_milli"])


# quality


@query
def target_coverage(t: Tables) -> DataFrame:
    return quality.target_coverage(t.targets(), t.samples(), AS_OF, timedelta(hours=3))


@query
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.users().unionByName(t.customers(RENAMED_USERS)), ["dbid", "user_id"])


# streams, run until the files there are taken


@query
def stream_ingest(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    streaming.ingest_samples(t.sample_stream(), f"{path}/samples", f"{path}/checkpoint").awaitTermination()
    return sources.read_samples(t.spark, f"{path}/samples")


@query
def store_lifecycle(t: Tables) -> DataFrame:
    """Three streamed parts of the samples, the second with rows of the first again and the last one late, then retention.

    A tenth is appended as a batch.
    """
    path = sources.work_folder(t.spark)
    part = F.pmod(F.xxhash64("session_id", "sample_time"), F.lit(10))
    steps = [part.between(6, 8), part.between(4, 7), part < 4]
    for number, step in enumerate(steps):
        t.samples().where(step).write.parquet(f"{path}/in/{number}")
        stream = streaming.read_sample_stream(t.spark, f"{path}/in/*", t.samples().schema)
        streaming.ingest_samples(stream, f"{path}/samples", f"{path}/checkpoint").awaitTermination()
    sources.write_samples(t.samples().where(part == 9), f"{path}/samples")
    sources.drop_expired(t.spark, f"{path}/samples", "d", AS_OF)
    return retention.expire(sources.read_samples(t.spark, f"{path}/samples"), "d", AS_OF)


@query
def stream_activity(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    activity = streaming.activity_by_window(streaming.enrich(t.sample_stream(), t.event_names()), 3600, "1 hour")
    streaming.write_windows(activity, f"{path}/activity", f"{path}/checkpoint").awaitTermination()
    return streaming.read_windows(t.spark, f"{path}/activity", ["wait_class"])


@query
def stream_db_time(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    rows = streaming.enrich(t.sample_stream(), t.event_names()).where("session_type <> 'BACKGROUND'")
    keys = {"event": "case when session_state = 'ON CPU' then 'ON CPU' else event end", "sql_id": "sql_id"}
    counts = streaming.counts_by_window(rows, keys, 86400, "1 hour")
    streaming.write_windows(counts, f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return streaming.read_windows(t.spark, f"{path}/counts", list(keys))


@query
def stream_flagged_stats(t: Tables) -> DataFrame:
    path = sources.work_folder(t.spark)
    # six years of days arrive at once here, so by database only
    query = streaming.ingest_counters(
        t.instance_stat_stream(), f"{path}/stats", f"{path}/checkpoint", t.stat_names(), partitions=["dbid"]
    )
    query.awaitTermination()
    return t.spark.read.parquet(f"{path}/stats").drop("sample_date")


# composed jobs


def _row_counts(outputs: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in outputs.items()]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total


def _snapshot_outputs(t: Tables, more: dict[str, DataFrame] | None = None, names: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    stats, last = t.sqlstats(), 2001 * 12 + 6
    metrics = t.metric_history()
    early = F.col("begin_time") < F.lit(METRIC_LOADED.isoformat(sep=" ")).cast("timestamp")
    return jobs.snapshot(
        {
            "users": t.customers(),
            "data_files": t.data_files(),
            "sqltext": t.sqltext_by_plan(),
            "sqlstats": stats.where(F.col("snap_id") == last),
            "plan_lines": t.plan_lines(),
            "objects": t.objects(),
            "metric_history": metrics.drop("snap_id"),
            "system_events": t.system_events(),
            "event_histogram": t.event_histogram().drop("snap_id"),
            "time_model": t.time_model().drop("snap_id"),
            "iofuncstats": t.iofuncstats().drop("snap_id"),
            **(more or {}),
        },
        {
            "samples": t.samples(AS_OF - MONTH, AS_OF),
            "users": t.users(),
            "data_files": t.data_files(STORED_FILES),
            "sqltext": t.sqltext().where(F.col("dbid") == 1),
            "sqlstats": stats.where(F.col("snap_id") < last),
            "plan_lines": t.plan_lines().where(F.col("inst_id") == 1),
            "objects": t.objects().where(F.col("dbid") == 2),
            "metric_history": metrics.where(early),
            "metric_names": t.metric_names(),
            "targets": t.targets(),
            **(names or {}),
        },
        last,
        AS_OF,
        WEEK,
        MONTH,
        columns=COUNTERS,
    )


@query
def snapshot_job(t: Tables) -> DataFrame:
    return _row_counts(_snapshot_outputs(t))


def _dimension_loads(t: Tables, more: dict[str, DataFrame] | None = None, stored: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    names = t.event_names()
    return jobs.load_dimensions(
        {
            "event_names": names,
            "users": t.customers(),
            "stat_names": t.stat_names().drop("collect"),
            "time_model_names": t.time_model_names(),
            "extents": t.extents(),
            "data_files": t.data_files(),
            **(more or {}),
        },
        {
            "event_names": names.where(F.col("dbid") == 1),
            "users": t.users(),
            "stat_names": t.stat_names().where(F.col("dbid") == 1),
            "time_model_names": t.time_model_names().where(F.col("dbid") == 1),
            "extents": t.extents().where(F.col("segment_type") == "ECONOMY"),
            "data_files": t.data_files(STORED_FILES),
            **(stored or {}),
        },
    )


@query
def load_dimensions(t: Tables) -> DataFrame:
    return _row_counts(_dimension_loads(t))


@query
def report_sql_on_views(t: Tables) -> DataFrame:
    """Report SQL against the registered views."""
    register_views(t.spark, {"samples": t.samples(), "event_names": t.event_names()}, target=(1, 1))
    return t.spark.sql(
        "select wait_class, session_type, count(*) as cnt from `v$active_session_history`"
        " where session_type <> 'BACKGROUND' group by wait_class, session_type"
    )


from demo import stored  # noqa: E402, F401  registers the queries on stored tables
