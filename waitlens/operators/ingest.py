"""From raw session and counter rows of the monitored instances to rows of the repository."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.constants import (
    IO_EVENT_NAMES,
    METRIC_FIRST_LOAD_DAYS,
    METRIC_MIN_CENTISECONDS,
    METRIC_NAMES,
    V9_IDLE_EVENTS,
)
from waitlens.functions import blocker_instance, blocker_session, has_bits, null_if, timestamp_lit
from waitlens.operators.joins import lookup

Target = tuple[int, int]

_RAW_ONLY = ("ksspaflg", "ksuseflg", "ksuseidl", "ksusetim", "ksuseopc", "ksusefblocker", "ksusstmbv")
_PLSQL_VISIBLE = 2048
_SESSION_SALT = ("inst_id", "session_id", "sample_time")


def _salt_columns(df: DataFrame, wanted: Sequence[str] = _SESSION_SALT) -> list[str]:
    return [name for name in wanted if name in df.columns]


def decode_blocker(df: DataFrame, column: str, layout: int = 16, prefix: str = "") -> DataFrame:
    """Add the blocking instance and session held in a blocker code."""
    return df.withColumns(
        {
            f"{prefix}blocking_instance": blocker_instance(column, layout),
            f"{prefix}blocking_session": blocker_session(column, layout),
        }
    )


def active_sessions(
    raw: DataFrame,
    event_names: DataFrame,
    mode: str = "v19",
    exclude_session: int | DataFrame | None = None,
    layout: int | None = None,
) -> DataFrame:
    """Keep the active, non-idle user sessions and decode their fields.

    ``mode`` picks the activity rule of the host version: ``v19``, ``v10`` (10 to 12) or ``v9``. ``exclude_session`` is
    the collector's own session: one id, or a frame (dbid, inst_id, session_id) with one row per target.
    """
    if mode not in ("v19", "v10", "v9"):
        raise ValueError(f"unknown mode {mode}")
    layout = layout or (18 if mode == "v19" else 16)
    rows = raw.where(has_bits("ksspaflg", 1)).where(has_bits("ksuseflg", 1))
    running = f"ksusetim <> 0 and {has_bits('ksuseidl', 11, 1)}"
    if isinstance(exclude_session, DataFrame):
        rows = lookup(rows, exclude_session, ["dbid", "inst_id", "session_id"], "left_anti", ["sample_time"])
    elif exclude_session is not None:
        rows = rows.where(F.col("session_id") != exclude_session)

    if mode == "v9":
        idle = event_names.where(F.lower("name").isin(list(V9_IDLE_EVENTS)))
    else:
        idle = event_names.where(F.col("wait_class") == "Idle")
    idle = idle.select("dbid", F.col("event_no").alias("ksuseopc"))
    salt = _salt_columns(rows)

    if mode == "v9":
        marked = lookup(rows, idle.distinct().withColumn("is_idle", F.lit(True)), ["dbid", "ksuseopc"], "left", salt)
        rows = marked.where(f"({running}) or (ksuseopc is not null and is_idle is null)").drop("is_idle")
    else:
        active = running if mode == "v10" else has_bits("ksuseidl", 9, 1)
        rows = lookup(rows.where(active).where("ksuseopc is not null"), idle, ["dbid", "ksuseopc"], "left_anti", salt)
    return _decode_session(rows, layout)


def _decode_session(rows: DataFrame, layout: int) -> DataFrame:
    have = set(rows.columns)
    decoded: dict[str, Column] = {
        "session_state": F.when(F.col("ksusetim") == 0, "WAITING").otherwise("ON CPU"),
        "session_type": F.col("ksuseflg"),
        "event_no": F.col("ksuseopc"),
        "wait_time": F.col("ksusetim"),
    }
    if "sql_child_number" in have:
        decoded["sql_child_number"] = null_if("sql_child_number", 65535)
    if "sql_exec_id" in have:
        decoded["sql_exec_id"] = null_if("sql_exec_id", 0)
    if {"plsql_entry_object_id", "plsql_entry_subprogram_id"} <= have:
        entry = F.col("plsql_entry_object_id")
        decoded["plsql_entry_subprogram_id"] = F.when(entry.isNull() | (entry != 0), F.col("plsql_entry_subprogram_id"))
        decoded["plsql_entry_object_id"] = null_if("plsql_entry_object_id", 0)
    if "ksusstmbv" in have:
        visible = F.expr(has_bits("ksusstmbv", _PLSQL_VISIBLE, _PLSQL_VISIBLE))
        for name in {"plsql_object_id", "plsql_subprogram_id"} & have:
            decoded[name] = F.when(visible & (F.col(name) != 0), F.col(name))
    rows = decode_blocker(rows, "ksuseblocker", layout)
    if "ksusefblocker" in have:
        rows = decode_blocker(rows, "ksusefblocker", layout, prefix="final_")
    return rows.withColumns(decoded).drop(*_RAW_ONLY)


def stamp_samples(df: DataFrame, target: Target | None = None) -> DataFrame:
    """Give every row of one poll the same sample id; ``target`` sets dbid and instance where the rows lack them."""
    if target is not None:
        df = df.withColumns({"dbid": F.lit(target[0]).cast("bigint"), "inst_id": F.lit(target[1]).cast("bigint")})
    return df.withColumn("sample_id", F.unix_timestamp("sample_time"))


def append_new(source: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not stored yet; a null among the stored keys hides nothing."""
    return lookup(source, existing, keys, "left_anti")


def append_strict(source: DataFrame, existing: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """All source rows, or none if any key is stored already or comes twice.

    With ``strict`` a clash raises ValueError; this runs one bounded check.
    """
    keys = list(keys)
    stored = lookup(source.select(*keys), existing, keys, "left_semi")
    repeated = source.groupBy(*keys).count().where("count > 1").select(*keys)
    clashes = stored.unionByName(repeated)
    if strict:
        if not clashes.isEmpty():
            raise ValueError(f"keys {keys} are already stored or repeated")
        return source
    return source.where(~clashes.exists())


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """The whole table after a merge: matched rows take ``update_cols``, unmatched updates are added.

    Only the updates and the matched keys are moved when the updates are small. Keys of ``updates`` must be unique.
    """
    keys, update_cols = list(keys), list(update_cols)
    new = {name: f"__new_{name}" for name in update_cols}
    changes = updates.select(*keys, *[F.col(c).alias(n) for c, n in new.items()], F.lit(True).alias("__hit"))
    merged = lookup(base, changes, keys, "left")
    replaced = {c: F.when(F.col("__hit"), F.col(n)).otherwise(F.col(c)) for c, n in new.items()}
    merged = merged.withColumns(replaced).select(*base.columns)
    matched = lookup(base.select(*keys), updates.select(*keys), keys, "left_semi").distinct()
    added = updates.join(matched, keys, "left_anti")
    missing = {c: F.lit(None).cast(base.schema[c].dataType) for c in base.columns if c not in added.columns}
    return merged.unionByName(added.withColumns(missing).select(*base.columns))


def select_names(df: DataFrame, names: Sequence[str] = METRIC_NAMES, column: str = "metric_name") -> DataFrame:
    """Distinct rows whose name is on the list."""
    return df.where(F.col(column).isin(list(names))).distinct()


def snapshot_stamp(df: DataFrame, snap_id: int | Column, target: Target | None = None, inst_col: str = "inst_id") -> DataFrame:
    """Tag counter rows with their snapshot and, if given, their target."""
    stamp = {"snap_id": (snap_id if isinstance(snap_id, Column) else F.lit(snap_id)).cast("bigint")}
    if target is not None:
        stamp |= {"dbid": F.lit(target[0]).cast("bigint"), inst_col: F.lit(target[1]).cast("bigint")}
    return df.withColumns(stamp)


def _timed(df: DataFrame, as_of: datetime | None) -> DataFrame:
    return df if as_of is None else df.withColumn("sample_time", timestamp_lit(as_of))


def io_event_snapshot(
    system_events: DataFrame,
    snap_id: int | Column,
    target: Target | None = None,
    names: Sequence[str] = IO_EVENT_NAMES,
    as_of: datetime | None = None,
) -> DataFrame:
    """Counters of the I/O events only, tagged with the snapshot and, if given, its time."""
    rows = system_events.where(F.col("event").isin(list(names)))
    return snapshot_stamp(_timed(rows, as_of), snap_id, target)


def flagged_stats(stats: DataFrame, stat_names: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Instance statistics whose name row has ``collect = 1``, with the time of the reading if given."""
    flagged = stat_names.where("collect = 1")
    return _timed(lookup(stats, flagged, ["dbid", "statistic"], "left_semi", _salt_columns(stats)), as_of)


def metric_increment(
    source: DataFrame,
    loaded: DataFrame | None,
    names: DataFrame,
    as_of: datetime,
    min_centiseconds: int = METRIC_MIN_CENTISECONDS,
    first_load_days: int = METRIC_FIRST_LOAD_DAYS,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Metric rows later than the newest loaded row of their target, long intervals and named metrics only.

    A target of which nothing is loaded yet gets the last ``first_load_days``. ``marks`` (dbid, inst_id, mark), one row a target,
    says how far targets are loaded; then ``loaded`` is not read and may be None.
    """
    target = ["dbid", "inst_id"]
    if marks is None:
        mark = loaded.groupBy(*target).agg(F.max("begin_time").alias("__mark"))
    else:
        mark = marks.select(*target, F.col("mark").alias("__mark"))
    salt = ["metric_id", "begin_time"]
    rows = source.where(F.col("intsize_csec") > min_centiseconds)
    rows = lookup(rows, names, ["dbid", "metric_id"], "left_semi", ["inst_id", "begin_time"])
    rows = lookup(rows, mark, target, "left", salt)
    floor = timestamp_lit(as_of - timedelta(days=first_load_days))
    return rows.where(F.col("begin_time") > F.coalesce("__mark", floor)).drop("__mark")


def register_snapshots(df: DataFrame, time_col: str | None = None, inst_col: str = "inst_id") -> DataFrame:
    """One registry row per snapshot and target, with its earliest time if there is one."""
    keys = [F.col("snap_id").alias("hist_sample_id"), F.col("dbid"), F.col(inst_col).alias("instance_number")]
    if time_col is None:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(F.min(time_col).alias("hist_date"))
