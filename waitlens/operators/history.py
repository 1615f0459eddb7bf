"""History views over the stored samples, counters and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.constants import SNAPSHOT_MINUTES, SQLSTAT_DELTAS
from waitlens.functions import blocker_session, blocker_status, session_type_name
from waitlens.operators.delta import counter_delta
from waitlens.operators.joins import fits_broadcast, lookup, range_lookup
from waitlens.operators.times import DAY

Target = tuple[int, int]

# Columns that the session history takes from the samples, and those it has but never fills.
COPIED = (
    "dbid",
    "inst_id",
    "sample_time",
    "session_id",
    "session_state",
    "session_serial",
    "user_id",
    "sql_address",
    "sql_id",
    "sql_plan_hash_value",
    "sql_opcode",
    "seq_no",
    "p1",
    "p2",
    "p3",
    "wait_time",
    "current_obj",
    "current_file",
    "current_block",
    "current_row",
    "program",
    "module",
    "action",
    "service_name",
    "fixed_table_sequence",
    "sample_id",
    "sql_child_number",
    "sql_exec_id",
    "sql_exec_start",
    "plsql_entry_object_id",
    "plsql_entry_subprogram_id",
    "plsql_object_id",
    "plsql_subprogram_id",
    "time_waited",
    "sample_date",
)

ALWAYS_NULL = {
    "flags": T.LongType(),
    "force_matching_signature": T.LongType(),
    "top_level_sql_id": T.StringType(),
    "top_level_sql_opcode": T.LongType(),
    "sql_plan_line_id": T.LongType(),
    "sql_plan_operation": T.StringType(),
    "sql_plan_options": T.StringType(),
    "qc_session_serial": T.LongType(),
    "blocking_session_serial": T.LongType(),
    "consumer_group_id": T.LongType(),
    "xid": T.StringType(),
    "remote_instance": T.LongType(),
    "in_connection_mgmt": T.StringType(),
    "in_parse": T.StringType(),
    "in_hard_parse": T.StringType(),
    "in_sql_execution": T.StringType(),
    "in_plsql_execution": T.StringType(),
    "in_plsql_rpc": T.StringType(),
    "in_plsql_compilation": T.StringType(),
    "in_java_execution": T.StringType(),
    "in_bind": T.StringType(),
    "in_cursor_close": T.StringType(),
    "service_hash": T.LongType(),
    "client_id": T.StringType(),
}

_SAMPLE_SALT = ("session_id", "sample_id", "sample_time")

# hundredths of a second to whole microseconds, so that the sum with the timestamp is exact
_METRIC_END = "timestamp_micros(unix_micros(begin_time) + intsize_csec * 10000)"
_EVENT = "case when session_state = 'WAITING' then name end as event"
_WAIT_CLASS = "coalesce(wait_class, 'Other') as wait_class"


def of_target(df: DataFrame, target: Target | None, inst_col: str = "inst_id") -> DataFrame:
    if target is None:
        return df
    return df.where((F.col("dbid") == target[0]) & (F.col(inst_col) == target[1]))


def session_history(
    samples: DataFrame,
    event_names: DataFrame,
    target: Target | None = None,
    layout: int = 16,
    compat: bool = False,
) -> DataFrame:
    """Samples with event, wait class, session type, coordinator and blocker decoded.

    Samples of unknown events drop out; a null class becomes ``Other``. ``compat`` adds the columns that are always
    null. Only columns the samples have are copied; a ``sample_date`` partition column stays for the time filters.
    """
    names = event_names.select("dbid", "event_no", "name", "wait_class", "wait_class_id")
    if target is not None:
        names = names.where(F.col("dbid") == target[0])
    have = set(samples.columns)
    salt = [c for c in _SAMPLE_SALT if c in have]
    rows = lookup(of_target(samples, target), names, ["dbid", "event_no"], "inner", salt)

    columns = [c for c in COPIED if c in have]
    columns += [
        session_type_name("session_type").alias("session_type"),
        F.expr("case when session_state = 'WAITING' then event_no end as event_no"),
        F.expr("case when session_state = 'WAITING' then event_no end as event_id"),
        F.expr(_EVENT),
        F.expr(_WAIT_CLASS),
        "wait_class_id",
    ]
    if "qc" in have:
        columns += [F.expr("case when qc is not null then inst_id end as qc_instance_id"), F.expr("qc as qc_session_id")]
    columns += [F.expr(f"{p} as {p}text") for p in ("p1", "p2", "p3") if p in have]
    if "ksuseblocker" in have:
        columns += [
            blocker_session("ksuseblocker", layout).alias("blocking_session"),
            blocker_status("ksuseblocker").alias("blocking_session_status"),
        ]
    if compat:
        columns += [F.lit(None).cast(t).alias(c) for c, t in ALWAYS_NULL.items()]
    return rows.select(*columns)


def named_counts(
    samples: DataFrame, event_names: DataFrame, keys: Mapping[str, str], salt_on: Sequence[str] | None = None
) -> DataFrame:
    """Samples with a count ``n`` per key, state, event and wait class; keys are SQL expressions over the samples.

    Names that can be broadcast are joined to the single samples (``n`` is 1); otherwise the samples are counted first,
    so that only the counts move for the join.
    """
    names = event_names.select("dbid", "event_no", "name", "wait_class")
    counts = samples.selectExpr("dbid", "event_no", "session_state", *[f"{e} as {k}" for k, e in keys.items()], "1L as n")
    if not fits_broadcast(names):
        counts = counts.groupBy("dbid", "event_no", "session_state", *keys).agg(F.sum("n").alias("n"))
    named = lookup(counts, names, ["dbid", "event_no"], "inner", salt_on or list(keys))
    return named.selectExpr(*keys, "session_state", _EVENT, _WAIT_CLASS, "n")


def sampled_by_snapshot(
    history: DataFrame, snapshots: DataFrame, minutes: int = SNAPSHOT_MINUTES
) -> DataFrame:
    """One in ten history rows (seconds ending in 0) with the snapshots whose interval holds them.

    Both ends of an interval count, so a row on a shared end has two snapshots. Where the rows have a ``sample_date`` partition
    column, only the days that the snapshots touch are read.
    """
    seconds = minutes * 60
    thinned = history.where(F.second("sample_time") % 10 == 0)
    if DAY in history.columns:
        later = F.explode(F.array(*[F.lit(n) for n in range(2 + minutes // 1440)])).alias("later")
        days = snapshots.select("hist_date", later).select(F.date_add(F.to_date("hist_date"), F.col("later")).alias(DAY)).distinct()
        if fits_broadcast(days):
            thinned = thinned.join(F.broadcast(days), [DAY], "left_semi")
    begin = F.unix_timestamp("hist_date")
    intervals = snapshots.select(
        F.col("hist_sample_id").alias("snap_id"),
        F.col("dbid").alias("dbid"),
        F.col("instance_number").alias("inst_id"),
        begin.alias("__begin"),
    )
    joined = range_lookup(
        thinned,
        intervals,
        ["dbid", "inst_id"],
        point=F.unix_timestamp("sample_time"),
        start=F.col("__begin"),
        stop=F.col("__begin") + seconds,
        width=seconds,
        max_buckets=2,
        salt_on=[c for c in _SAMPLE_SALT if c in history.columns],
        interval_columns=["snap_id"],
    )
    rest = [c for c in history.columns if c not in ("dbid", "inst_id")]
    return joined.select("snap_id", "dbid", F.col("inst_id").alias("instance_number"), *rest)


def snapshot_list(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        F.col("hist_sample_id").alias("snap_id"), "dbid", "instance_number", F.col("hist_date").alias("begin_interval_time")
    )


def metric_history(metrics: DataFrame, names: DataFrame, target: Target | None = None, dbid: int | None = None) -> DataFrame:
    """Metric values with name and end of interval; metrics without a name drop out."""
    rows = of_target(metrics, target)
    if dbid is not None:
        rows = rows.where(F.col("dbid") == dbid)
    named = lookup(
        rows, names.select("dbid", "metric_id", "metric_name", "metric_unit"), ["dbid", "metric_id"], "inner", ["inst_id", "begin_time"]
    )
    return named.select(
        "snap_id",
        "dbid",
        F.col("inst_id").alias("instance_number"),
        "begin_time",
        F.expr(_METRIC_END).alias("end_time"),
        F.col("intsize_csec").alias("intsize"),
        "group_id",
        "metric_id",
        "metric_name",
        "value",
        "metric_unit",
    )


def metric_summary(metrics: DataFrame, names: DataFrame, target: Target | None = None, dbid: int | None = None) -> DataFrame:
    """Per snapshot and metric: span, number of intervals, min, max, mean and sample standard deviation.

    Ids are summarised first and named afterwards, which moves neither names nor single values.
    """
    rows = of_target(metrics, target)
    if dbid is not None:
        rows = rows.where(F.col("dbid") == dbid)
    keys = ["snap_id", "dbid", F.col("inst_id").alias("instance_number"), "group_id", "metric_id"]
    summary = rows.groupBy(*keys).agg(
        F.min("begin_time").alias("begin_time"),
        F.max(F.expr(_METRIC_END)).alias("end_time"),
        F.max("intsize_csec").alias("intsize"),
        F.count("*").alias("num_interval"),
        F.min("value").alias("minval"),
        F.max("value").alias("maxval"),
        F.avg("value").alias("average"),
        F.stddev_samp("value").alias("standard_deviation"),
    )
    named = names.select("dbid", "metric_id", "metric_name", "metric_unit")
    return lookup(summary, named, ["dbid", "metric_id"], "inner", ["snap_id", "instance_number"])


MOMENT_KEYS = ("dbid", "instance_number", "group_id", "metric_id")


def metric_moments(metrics: DataFrame, by: Sequence[str] = ("snap_id",)) -> DataFrame:
    """Per metric and ``by``: span, number, min, max, mean and the sum of squared deviations ``m2``, to be kept and merged."""
    keys = [*by, "dbid", F.col("inst_id").alias("instance_number"), "group_id", "metric_id"]
    return metrics.groupBy(*keys).agg(
        F.min("begin_time").alias("begin_time"),
        F.max(F.expr(_METRIC_END)).alias("end_time"),
        F.max("intsize_csec").alias("intsize"),
        F.count("*").alias("num_interval"),
        F.count("value").alias("n"),
        F.min("value").alias("minval"),
        F.max("value").alias("maxval"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
    )


def merge_moments(moments: DataFrame, by: Sequence[str] = ("snap_id",)) -> DataFrame:
    """Moments of longer spans, or of parts that came late, from those of the parts; no value is needed.

    Squared deviations are taken from the common mean: those of a part, plus its number times the square of its distance.
    Columns in ``by`` may be any of ``moments``.
    """
    keys = [*by, *MOMENT_KEYS]
    whole = Window.partitionBy(*keys)
    middle = F.sum(F.col("n") * F.col("mean")).over(whole) / F.nullif(F.sum("n").over(whole), F.lit(0))
    parts = moments.withColumn("__middle", middle)
    apart = F.col("mean") - F.col("__middle")
    return parts.groupBy(*keys).agg(
        F.min("begin_time").alias("begin_time"),
        F.max("end_time").alias("end_time"),
        F.max("intsize").alias("intsize"),
        F.sum("num_interval").alias("num_interval"),
        F.sum("n").alias("n"),
        F.min("minval").alias("minval"),
        F.max("maxval").alias("maxval"),
        F.max("__middle").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * apart * apart).alias("m2"),
    )


def summary_of_moments(moments: DataFrame, names: DataFrame, by: Sequence[str] = ("snap_id",)) -> DataFrame:
    """``metric_summary`` from stored moments."""
    merged = merge_moments(moments, by)
    deviation = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    summary = merged.withColumn("standard_deviation", deviation).withColumnRenamed("mean", "average").drop("n", "m2")
    named = names.select("dbid", "metric_id", "metric_name", "metric_unit")
    return lookup(summary, named, ["dbid", "metric_id"], "inner", [*by, "instance_number"])


def sqlstat_history(
    sqlstats: DataFrame,
    target: Target | None = None,
    dbid: int | None = None,
    columns: Mapping[str, str] | Sequence[str] | None = None,
) -> DataFrame:
    """SQL counters with their deltas, one database or all; deltas that are stored already are not computed again."""
    rows = of_target(sqlstats, target, "instance_number")
    if dbid is not None:
        rows = rows.where(F.col("dbid") == dbid)
    if columns is None:
        columns = {c: d for c, d in SQLSTAT_DELTAS.items() if c in rows.columns}
    names = columns.values() if isinstance(columns, Mapping) else [f"{c}_delta" for c in columns]
    return rows if set(names) <= set(rows.columns) else counter_delta(rows, columns=columns)


def latest_snapshot(
    df: DataFrame, snapshots: DataFrame, target: Target | None = None, salt_on: Sequence[str] = ("sql_id", "plan_hash_value")
) -> DataFrame:
    """Rows of the newest registered snapshot of each target."""
    registered = of_target(snapshots, target, "instance_number")
    newest = registered.groupBy("dbid", "instance_number").agg(F.max("hist_sample_id").alias("snap_id"))
    salt = [c for c in salt_on if c in df.columns]
    rows = lookup(of_target(df, target, "instance_number"), newest, ["dbid", "instance_number", "snap_id"], "left_semi", salt)
    return rows.select(*df.columns)


def event_histogram(histogram: DataFrame, event_names: DataFrame, dbid: int | None = None) -> DataFrame:
    """Wait-time histogram with event id, name and class; the class id is always null."""
    rows = histogram if dbid is None else histogram.where(F.col("dbid") == dbid)
    names = event_names.select("dbid", "event_no", "event_id", "name", "wait_class")
    named = lookup(rows, names, ["dbid", "event_no"], "inner", ["snap_id", "wait_time_milli"])
    return named.select(
        "snap_id",
        "dbid",
        F.col("inst_id").alias("instance_number"),
        "event_id",
        F.col("name").alias("event_name"),
        F.lit(None).cast("bigint").alias("wait_class_id"),
        "wait_class",
        "wait_time_milli",
        "wait_count",
    )


def time_model(values: DataFrame, names: DataFrame, dbid: int | None = None, key: str = "stat_id") -> DataFrame:
    """Time-model values with names; ``key="osstat_id"`` does the same for operating-system statistics."""
    rows = values if dbid is None else values.where(F.col("dbid") == dbid)
    named = lookup(rows, names.select("dbid", key, "stat_name"), ["dbid", key], "inner", ["snap_id", "inst_id"])
    return named.select("snap_id", "dbid", F.col("inst_id").alias("instance_number"), key, "stat_name", "value")
