"""Reports over the session history: load by SQL, session, event and time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.constants import (
    GRAPH_BUCKET_SECONDS,
    GRAPH_CLASS_ORDER,
    GRAPH_FILLER,
    GRAPH_MINUTES,
    REPORT_TITLES, REPORT_WAIT_CLASSES,
    TOP_SQL_ROWS,
)
from waitlens.functions import bucket_start, bucket_text, session_type_name, share_percent, timestamp_text
from waitlens.operators.history import named_counts
from waitlens.operators.times import in_range, recent

HOUR = timedelta(hours=1)
THREE_HOURS = timedelta(hours=3)


def _counted(rows: DataFrame, event_names: DataFrame | None, keys: Mapping[str, str]) -> DataFrame:
    """Keys (SQL expressions), session state, event and wait class with a number of samples ``n``.

    Rows of the session history count one each; with ``event_names`` the rows are stored samples.
    """
    if event_names is not None:
        return named_counts(rows, event_names, keys)
    return rows.selectExpr(*[f"{e} as {k}" for k, e in keys.items()], "session_state", "event", "wait_class", "1L as n")


def _sum_if(condition: str) -> Column:
    """Number of samples that meet the condition, null if none does."""
    return F.expr(f"sum(case when {condition} then n end)")


def top_sql_by_wait_class(
    history: DataFrame, start: datetime, stop: datetime, n: int = TOP_SQL_ROWS, event_names: DataFrame | None = None
) -> DataFrame:
    """Samples per statement, split by wait class and CPU; ``Total`` counts every class. Both ends of the range count.

    ``history`` holds the session history or, with ``event_names``, the stored samples.
    """
    rows = in_range(history, start, stop).where("sql_id is not null and session_state in ('ON CPU', 'WAITING')")
    counts = _counted(rows, event_names, {"sql_id": "sql_id"})
    on_cpu = _sum_if("session_state = 'ON CPU'").alias("CPU")
    classes = [_sum_if(f"session_state = 'WAITING' and wait_class = '{c}'").alias(REPORT_TITLES.get(c, c)) for c in REPORT_WAIT_CLASSES]
    totals = counts.groupBy("sql_id").agg(on_cpu, *classes, F.sum("n").alias("Total"))
    return totals.orderBy(F.desc("Total"), F.asc("sql_id")).limit(n)


def load_by(
    history: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    event: str | None = None,
    event_names: DataFrame | None = None,
) -> DataFrame:
    """Number of samples per key and its share of all samples in percent.

    Keys are SQL expressions over the rows; ``event`` is one more key, over state, event and wait class. The total is
    taken from the counts, as a one-value subquery that reuses their shuffle.
    """
    if not isinstance(keys, Mapping):
        keys = {k: k for k in keys}
    rows = _counted(history, event_names, keys)
    grouping = [*keys] if event is None else [*keys, F.expr(event).alias("event")]
    counts = rows.groupBy(*grouping).agg(F.sum("n").alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pctload", share_percent("cnt", total))


def _heaviest_first(load: DataFrame) -> DataFrame:
    return load.orderBy(F.desc("cnt"), *[c for c in load.columns if c not in ("cnt", "pctload")])


_EVENT_OR_CPU = "case when session_state = 'ON CPU' then 'ON CPU' else event end"
_SQL_KEYS = ("sql_id", "sql_plan_hash_value")


def class_or_cpu() -> Column:
    return F.expr("case when session_state = 'WAITING' then wait_class when session_state = 'ON CPU' then 'ON CPU' end")


def _foreground(history: DataFrame) -> DataFrame:
    return history.where(F.col("session_type") != "BACKGROUND")


def db_time_by_sql(
    history: DataFrame,
    as_of: datetime,
    span: timedelta = HOUR,
    unit: str = "minute",
    event_names: DataFrame | None = None,
) -> DataFrame:
    """Load by time unit, event or CPU, statement and plan, without background sessions.

    ``history`` holds the session history or, with ``event_names``, the stored samples.
    """
    rows = recent(history, as_of, span)
    if event_names is not None:
        rows = rows.withColumn("session_type", session_type_name("session_type"))
    keys = {"sample_time": f"date_trunc('{unit}', sample_time)"} | {k: k for k in _SQL_KEYS}
    load = load_by(_foreground(rows), keys, _EVENT_OR_CPU, event_names)
    return load.select("sample_time", "event", *_SQL_KEYS, "cnt", "pctload").orderBy(F.desc("sample_time"), F.desc("cnt"), "event", *_SQL_KEYS)


def event_rows(history: DataFrame, event: str, as_of: datetime, span: timedelta = HOUR) -> DataFrame:
    """History rows of one event, without background sessions."""
    return _foreground(recent(history, as_of, span)).where(F.col("event") == event)


def event_details(history: DataFrame, event: str, as_of: datetime, span: timedelta = HOUR) -> DataFrame:
    """Who waited for one event, newest first."""
    wanted = ("sample_time", "sql_opcode", "session_state", "p1text", "program", "module")
    rows = event_rows(history, event, as_of, span)
    shown = [c for c in wanted if c in rows.columns]
    return rows.select(*shown).orderBy(F.desc("sample_time"), *shown[1:])


def top_sessions(history: DataFrame, as_of: datetime, span: timedelta = HOUR) -> DataFrame:
    return _heaviest_first(load_by(recent(history, as_of, span), ["session_id"]))


def _session(history: DataFrame, session_id: int, as_of: datetime, span: timedelta) -> DataFrame:
    return recent(history, as_of, span).where(F.col("session_id") == session_id)


def session_details(history: DataFrame, session_id: int, as_of: datetime, span: timedelta = THREE_HOURS) -> DataFrame:
    """History rows of one session, newest first."""
    rows = _session(history, session_id, as_of, span)
    return rows.orderBy(F.desc("sample_time"), *[c for c in ("dbid", "inst_id", "sample_id", "session_serial") if c in rows.columns])


def session_sqls(history: DataFrame, session_id: int, as_of: datetime, span: timedelta = THREE_HOURS) -> DataFrame:
    return _heaviest_first(load_by(_session(history, session_id, as_of, span), _SQL_KEYS))


def session_events(history: DataFrame, session_id: int, as_of: datetime, span: timedelta = THREE_HOURS) -> DataFrame:
    return _heaviest_first(load_by(_session(history, session_id, as_of, span), [], "event"))


def session_sql_events(history: DataFrame, session_id: int, as_of: datetime, span: timedelta = THREE_HOURS) -> DataFrame:
    load = load_by(_session(history, session_id, as_of, span), _SQL_KEYS, _EVENT_OR_CPU)
    return _heaviest_first(load.select("event", *_SQL_KEYS, "cnt", "pctload"))


def sqlstats_for_sql(latest: DataFrame, sql_id: str) -> DataFrame:
    """Latest counters of one statement."""
    return latest.where(F.col("sql_id") == sql_id)


def activity_graph(
    history: DataFrame,
    event_names: DataFrame,
    as_of: datetime,
    minutes: int = GRAPH_MINUTES,
    bucket_s: int = GRAPH_BUCKET_SECONDS,
    sample_interval_s: int = 1,
    stored: bool = False,
) -> DataFrame:
    """Average active sessions per time bucket and wait class.

    ``history`` holds the session history or, with ``stored``, the stored samples.

    A filler row ``null`` stands in every bucket of the window, and one row of every class that is not idle stands at
    the left edge, so that a chart shows all buckets and knows all classes. Rows are ordered by bucket, then (left edge
    only) by ``wait_order``.
    """
    spark = history.sparkSession
    rows = recent(history, as_of, timedelta(minutes=minutes))
    per_bucket = bucket_s / sample_interval_s
    counts = _counted(rows, event_names if stored else None, {"bucket_time": bucket_text("sample_time", bucket_s)})
    active = counts.groupBy("bucket_time", class_or_cpu().alias("wait_class")).agg((F.sum("n") / per_bucket).alias("cnt"))

    steps = spark.range(1, minutes * 60 // bucket_s + 1)
    back = f"timestamp_seconds(unix_timestamp({timestamp_text(as_of)}) - id * {bucket_s})"
    spine = steps.select(bucket_start(back, bucket_s).alias("bucket_time"), F.lit("null").alias("wait_class"))

    edge_time = bucket_start(timestamp_text(as_of - timedelta(minutes=minutes + 1)), bucket_s)
    classes = event_names.where("wait_class <> 'Idle'").select("wait_class").distinct()
    fixed = spark.range(2).selectExpr("case when id = 0 then 'null' else 'ON CPU' end as wait_class")
    order = " ".join(f"when '{c}' then {i}" for i, c in enumerate(GRAPH_CLASS_ORDER))
    edge = classes.unionByName(fixed).select(
        edge_time.alias("bucket_time"), "wait_class", F.expr(f"case wait_class {order} end as wait_order")
    )
    fillers = edge.unionByName(spine, allowMissingColumns=True).withColumn("cnt", F.lit(GRAPH_FILLER))
    points = fillers.unionByName(active, allowMissingColumns=True)
    return points.select(
        "bucket_time", F.date_format("bucket_time", "HH:mm:ss").alias("dtime"), "wait_class", "cnt", "wait_order"
    ).orderBy("bucket_time", F.asc_nulls_last("wait_order"), "wait_class")
