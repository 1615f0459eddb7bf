"""Differences of cumulative counters between consecutive snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.constants import SQLSTAT_DELTAS
from waitlens.operators.joins import lookup

TARGET = ("dbid", "instance_number")
ENTITY = ("dbid", "instance_number", "sql_id", "plan_hash_value")
BLOCK = 64


def counter_delta(
    df: DataFrame,
    entity: Sequence[str] = ENTITY,
    columns: Mapping[str, str] | Sequence[str] | None = None,
    snap: str = "snap_id",
    target: Sequence[str] = TARGET,
    snapshots: DataFrame | None = None,
    on_reset: str = "keep",
) -> DataFrame:
    """Add counter minus its value at the target's previous snapshot; null where the entity was absent there.

    ``df`` has one row per (entity, snapshot) and ``entity`` includes ``target``. Snapshots of a target are numbered, so
    "previous" means the number before and a gap of an entity is seen. Numbers are cut into blocks and the last row of a
    block also goes, as a carrier, to the next one: one shuffle, and no group over ``BLOCK`` + 1 rows however long the
    history of an entity is. ``snapshots`` (``target`` + ``snap``) replaces the snapshots found in ``df``.
    ``on_reset="null"`` drops negative deltas of restarted counters.
    """
    if on_reset not in ("keep", "null"):
        raise ValueError("on_reset must be 'keep' or 'null'")
    if columns is None:
        columns = {c: d for c, d in SQLSTAT_DELTAS.items() if c in df.columns}
    if not isinstance(columns, Mapping):
        columns = {c: f"{c}_delta" for c in columns}
    target, entity = list(target), list(entity)
    listed = (df if snapshots is None else snapshots).select(*target, snap).distinct()
    numbered = listed.withColumn("__no", F.row_number().over(Window.partitionBy(*target).orderBy(snap)))

    keep = [c for c in df.columns if c not in columns.values()]
    salt = [c for c in entity if c not in target]
    rows = lookup(df.select(*keep), numbered, [*target, snap], "inner", salt)
    block = F.floor(F.col("__no") / BLOCK)
    last_of_block = F.col("__no") % BLOCK == BLOCK - 1
    spots = F.when(last_of_block, F.array(block, block + 1)).otherwise(F.array(block))
    rows = rows.withColumn("__block", F.explode(spots))

    w = Window.partitionBy(*entity, "__block").orderBy("__no")
    follows = F.lag("__no").over(w) == F.col("__no") - 1
    changes = {}
    for counter, name in columns.items():
        change = F.when(follows, F.col(counter) - F.lag(counter).over(w))
        changes[name] = F.when(change >= 0, change) if on_reset == "null" else change
    rows = rows.withColumns(changes)
    return rows.where(F.floor(F.col("__no") / BLOCK) == F.col("__block")).drop("__no", "__block")
