"""Temporary views under the host's view names, so that existing report SQL runs in ``spark.sql``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.operators import dims, history
from waitlens.operators.times import recent
from waitlens.plans import plan_rows
from waitlens.sources.snapshots import SnapshotStore

Target = tuple[int, int]


def build_views(
    tables: Mapping[str, DataFrame], target: Target | None = None, as_of: datetime | None = None, minutes: int = 15
) -> dict[str, DataFrame]:
    """The views the given tables allow, for one target or the fleet. ``as_of`` bounds the recent-metric view."""
    dbid = None if target is None else target[0]
    have = set(tables)
    views: dict[str, DataFrame] = {}
    if {"samples", "event_names"} <= have:
        sessions = history.session_history(tables["samples"], tables["event_names"], target, compat=True)
        views["v$active_session_history"] = sessions
        if "snapshots" in have:
            views["dba_hist_active_sess_history"] = history.sampled_by_snapshot(sessions, tables["snapshots"], minutes)
    if "snapshots" in have:
        views["dba_hist_snapshot"] = history.snapshot_list(tables["snapshots"])
    if {"metric_history", "metric_names"} <= have:
        named = history.metric_history(tables["metric_history"], tables["metric_names"], dbid=dbid)
        views["dba_hist_sysmetric_history"] = named
        views["dba_hist_sysmetric_summary"] = history.metric_summary(tables["metric_history"], tables["metric_names"], dbid=dbid)
        if as_of is not None:
            of_instance = history.metric_history(tables["metric_history"], tables["metric_names"], target)
            views["v$sysmetric_history"] = recent(of_instance, as_of, timedelta(hours=2), "begin_time")
    if "sqlstats" in have:
        views["dba_hist_sqlstat"] = history.sqlstat_history(tables["sqlstats"], dbid=dbid)
        if "snapshots" in have:
            views["v$sqlstats"] = _now(history.latest_snapshot(tables["sqlstats"], tables["snapshots"], target))
    if {"iofuncstats", "snapshots"} <= have:
        views["v$iostat_function"] = _now(
            history.latest_snapshot(tables["iofuncstats"], tables["snapshots"], target, salt_on=("function_id",))
        )
    if {"event_histogram", "event_names"} <= have:
        views["dba_hist_event_histogram"] = history.event_histogram(tables["event_histogram"], tables["event_names"], dbid)
    if {"time_model", "time_model_names"} <= have:
        views["dba_hist_sys_time_model"] = history.time_model(tables["time_model"], tables["time_model_names"], dbid)
    if "sqltext" in have:
        texts = dims.for_target(tables["sqltext"], dbid)
        views["v$sqltext_with_newlines"] = texts.select("dbid", "sql_id", "sql_text")
        views["v$sql"] = dims.sql_list(tables["sqltext"], dbid)
    if "plan_lines" in have:
        views["v$sql_plan"] = plan_rows(tables["plan_lines"], dbid, compat=True)
    plain = {"v$parameter": "params", "dba_users": "users", "dba_data_files": "data_files", "all_objects": "objects"}
    for view, name in plain.items():
        if name in have:
            views[view] = dims.for_target(tables[name], dbid)
    if "targets" in have:
        of_target = history.of_target(tables["targets"], target, "inst_num")
        extra = {"version": "version", "sid": "instance_name"}
        known = {old: F.col(old).alias(new) for old, new in extra.items() if old in of_target.columns}
        views["v$instance"] = of_target.select(
            *[known[c] for c in ("version",) if c in known],
            F.col("inst_num").alias("instance_number"),
            F.col("host").alias("host_name"),
            *[known[c] for c in ("sid",) if c in known],
        )
        views["v$database"] = of_target.select(
            "dbid", F.col("host").alias("host_name"), *[known[c] for c in ("sid",) if c in known], F.col("dbname").alias("name")
        )
    return views


def _now(latest: DataFrame) -> DataFrame:
    """Present values as the host shows them: without the snapshot and the changes."""
    return latest.select(*[c for c in latest.columns if c not in ("snap_id", "run") and not c.endswith("_delta")])


def stored_tables(
    store: SnapshotStore,
    names: Sequence[str],
    start: datetime | None = None,
    stop: datetime | None = None,
    target: Target | None = None,
) -> dict[str, DataFrame]:
    """Tables of a snapshot store for the views, with its registry: of the snapshots from ``start`` to ``stop``, nothing else is
    read."""
    tables = {name: store.read(name, start, stop, target) for name in names}
    return tables | {"snapshots": store.snapshots(start, stop, target)}


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], target: Target | None = None, **options) -> list[str]:
    """Register the views for ``spark.sql``; a name with ``$`` needs backquotes there."""
    views = build_views(tables, target, **options)
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"`{name}`")
    return sorted(views)
