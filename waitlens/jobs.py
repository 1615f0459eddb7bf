"""Jobs composed of operators; each works on all targets at once and gives the new rows of every table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.constants import (
    HOT_OBJECT_ROWS,
    HOT_SQL_ROWS,
    SNAPSHOT_MINUTES,
    SQLSTAT_DELTAS,
    SQLSTAT_OTHER,
    STORED_COMMAND_TYPE,
)
from waitlens.functions import timestamp_lit
from waitlens.operators import hot as hot_sets
from waitlens.operators import ingest
from waitlens.operators.delta import counter_delta
from waitlens.operators.history import latest_snapshot
from waitlens.sources.snapshots import SnapshotStore, advance
from waitlens.sources.store import materialise, merge_buckets, replace_partitions

Tables = Mapping[str, DataFrame]
Target = tuple[int, int]

COUNTERS = (*SQLSTAT_DELTAS, *SQLSTAT_OTHER)
STAMPED = ("event_histogram", "time_model", "osstat", "iofuncstats")


def load_dimensions(sources: Tables, stored: Tables) -> dict[str, DataFrame]:
    """New rows of each name table of which ``sources`` has host rows (with dbid); run again, it adds nothing."""
    keys = {
        "event_names": ["dbid", "event_no"],
        "users": ["dbid", "user_id"],
        "params": ["dbid", "name"],
        "latches": ["dbid", "latch_no"],
        "stat_names": ["dbid", "statistic"],
        "metric_names": ["dbid", "metric_id"],
        "time_model_names": ["dbid", "stat_id"],
        "osstat_names": ["dbid", "osstat_id"],
        "extents": ["dbid", "file_id", "block_id"],
    }
    loads = {}
    for name, key in keys.items():
        if name not in sources:
            continue
        rows = sources[name]
        if name == "metric_names":
            rows = ingest.select_names(rows)
        elif name == "stat_names":
            rows = rows.withColumn("collect", F.lit(0).cast("bigint"))
        else:
            rows = rows.distinct()
        loads[name] = ingest.append_new(rows, stored[name], key)
    if "data_files" in sources:
        loads["data_files"] = ingest.upsert(stored["data_files"], sources["data_files"], ["dbid", "file_id"], ["file_name"])
    return loads


def _new_text(hot: DataFrame, sources: Tables, stored: Tables) -> DataFrame:
    texts = hot_sets.new_sql_text(hot, sources["sqltext"], stored["sqltext"])
    return texts.withColumn("command_type", F.lit(STORED_COMMAND_TYPE).cast("bigint"))


def _sqlstats_now(hot: DataFrame, sources: Tables, snap_id: int, columns: Sequence[str]) -> DataFrame:
    return ingest.snapshot_stamp(hot_sets.hot_sqlstats(hot, sources["sqlstats"].drop("snap_id"), columns), snap_id)


def _sqlstats_with_delta(hot: DataFrame, sources: Tables, stored: Tables, snap_id: int, columns: Sequence[str]) -> DataFrame:
    """Counters of hot SQL at this snapshot, with deltas against the target's previous one.

    The registry says which snapshot that was; without one in ``stored``, the counters themselves are searched for it.
    """
    now = _sqlstats_now(hot, sources, snap_id, columns)
    earlier = stored["sqlstats"].where(F.col("snap_id") < snap_id)
    if "snapshots" in stored:
        registry = stored["snapshots"].where(F.col("hist_sample_id") < snap_id)
    else:
        registry = ingest.register_snapshots(earlier, inst_col="instance_number")
    before = latest_snapshot(earlier, registry).select(*[c for c in now.columns if c in earlier.columns])
    both = before.unionByName(now, allowMissingColumns=True)
    deltas = {c: d for c, d in SQLSTAT_DELTAS.items() if c in columns}
    return counter_delta(both, columns=deltas).where(F.col("snap_id") == snap_id)


def _registry(targets: DataFrame, snap_id: int, as_of: datetime) -> DataFrame:
    return targets.select(
        F.lit(snap_id).cast("bigint").alias("hist_sample_id"),
        "dbid",
        F.col("inst_num").alias("instance_number"),
        timestamp_lit(as_of).alias("hist_date"),
    )


def snapshot(
    sources: Tables,
    stored: Tables,
    snap_id: int,
    as_of: datetime,
    span: timedelta = timedelta(minutes=SNAPSHOT_MINUTES),
    object_span: timedelta = timedelta(hours=1),
    n_sql: int = HOT_SQL_ROWS,
    n_objects: int = HOT_OBJECT_ROWS,
    columns: Sequence[str] = COUNTERS,
) -> dict[str, DataFrame]:
    """One snapshot of the whole fleet.

    ``sources`` holds the host's present rows (with dbid and instance), ``stored`` the repository. Parts whose source is
    missing are left out. All results are new rows, but ``data_files``, which is the merged table. The set of hot SQL is
    computed here and now, once; of ``sqlstats`` only the time that holds the previous snapshots need be given.

    State in place of history: ``stored["metric_marks"]`` says how far metrics are loaded, ``stored["sqlstats_last"]`` holds
    the last values of counters (None before the first run); with the latter the result has ``sqlstats_last``, the next ones.
    """
    hot = materialise(hot_sets.hot_sql(stored["samples"], as_of, span, n_sql))
    out: dict[str, DataFrame] = {}
    if "users" in sources:
        out["users"] = ingest.append_new(sources["users"], stored["users"], ["dbid", "user_id"])
    if "data_files" in sources:
        out["data_files"] = ingest.upsert(stored["data_files"], sources["data_files"], ["dbid", "file_id"], ["file_name"])
    if "sqltext" in sources:
        out["sqltext"] = _new_text(hot, sources, stored)
    if "sqlstats" in sources and "sqlstats_last" in stored:
        targets = stored["targets"].select("dbid", F.col("inst_num").alias("instance_number"))
        deltas = {c: d for c, d in SQLSTAT_DELTAS.items() if c in columns}
        now = materialise(_sqlstats_now(hot, sources, snap_id, columns))
        out["sqlstats"], out["sqlstats_last"] = advance(now, stored["sqlstats_last"], targets, deltas)
    elif "sqlstats" in sources:
        out["sqlstats"] = _sqlstats_with_delta(hot, sources, stored, snap_id, columns)
    if "plan_lines" in sources:
        out["plan_lines"] = hot_sets.new_plan_lines(hot, sources["plan_lines"], stored["plan_lines"])
    if "objects" in sources:
        out["objects"] = hot_sets.new_objects(
            stored["samples"], sources["objects"], stored["objects"], as_of, object_span, n_objects
        )
    if "metric_history" in sources:
        rows = ingest.metric_increment(
            sources["metric_history"], stored.get("metric_history"), stored["metric_names"], as_of, marks=stored.get("metric_marks")
        )
        out["metric_history"] = ingest.snapshot_stamp(rows, snap_id)
    if "system_events" in sources:
        out["io_events"] = ingest.io_event_snapshot(sources["system_events"], snap_id, as_of=as_of)
    if "instance_stats" in sources:
        out["instance_stats"] = ingest.flagged_stats(sources["instance_stats"], stored["stat_names"], as_of)
    for name in STAMPED:
        if name in sources:
            out[name] = ingest.snapshot_stamp(sources[name], snap_id)
    if "targets" in stored:
        out["snapshots"] = _registry(stored["targets"], snap_id, as_of)
    return out


def run_snapshot(
    store: SnapshotStore, sources: Tables, stored: Tables, snap_id: int, as_of: datetime, run: str | None = None, **options
) -> str:
    """One snapshot of the fleet, written to ``store`` all or nothing; gives the name of its run.

    How far metrics are loaded and the last values of counters come from the store; no history is read for them. ``stored``
    needs the samples, the names, the targets and the dimensions. Every output becomes visible with the commit at the end; a
    job that breaks off before shows nothing and is simply run again. Data files are merged after it into ``dims/data_files`` of
    the store, in buckets; that adds nothing twice either.
    """
    state = {"metric_marks": store.marks("metric_history"), "sqlstats_last": store.last_values()}
    writer = store.begin(run)
    now = {name: rows for name, rows in sources.items() if name != "data_files"}
    outputs = snapshot(now, {**stored, **state}, snap_id, as_of, **options)
    registry = outputs.pop("snapshots")
    for name, rows in outputs.items():
        if name == "sqlstats_last":
            writer.write_last(rows)
        else:
            stamped = rows if "snap_id" in rows.columns else rows.withColumn("snap_id", F.lit(snap_id).cast("bigint"))
            writer.write(name, stamped, mark="begin_time" if name == "metric_history" else None)
    writer.commit(registry)
    if "data_files" in sources:
        merge_buckets(sources["data_files"], f"{store.path}/dims/data_files", ["dbid", "file_id"], ["file_name"])
    return writer.run


def snapshot_one(
    sources: Tables,
    stored: Tables,
    sql_id: str,
    snap_id: int,
    as_of: datetime,
    target: Target | None = None,
    columns: Sequence[str] = COUNTERS,
) -> dict[str, DataFrame]:
    """A snapshot of one statement: its text, counters and plan lines, for every plan it was sampled with."""
    variants = materialise(hot_sets.sql_variants(stored["samples"], sql_id, target))
    targets = variants.select("dbid", F.col("inst_id").alias("inst_num")).distinct()
    return {
        "sqltext": _new_text(variants, sources, stored),
        "sqlstats": _sqlstats_with_delta(variants, sources, stored, snap_id, columns),
        "plan_lines": hot_sets.new_plan_lines(variants, sources["plan_lines"], stored["plan_lines"]),
        "snapshots": _registry(targets, snap_id, as_of),
    }


def write_outputs(outputs: Tables, base: str, run: str) -> None:
    """Write the result of a job below ``base``, one folder per table.

    Each run has its own partition, so a job that is repeated after a failure replaces its rows instead of adding them
    again. The merged ``data_files`` table goes to a folder of its own per run.
    """
    for name, rows in outputs.items():
        replace_partitions(rows.withColumn("run", F.lit(run)), f"{base}/{name}", ["run"])
