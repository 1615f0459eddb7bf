"""Rows that are kept when old data expires."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.constants import SAMPLE_RETENTION, SNAPSHOT_RETENTION_DAYS
from waitlens.functions import timestamp_lit
from waitlens.operators.joins import lookup
from waitlens.operators.times import in_range


def cutoff(mode: str, as_of: datetime) -> datetime:
    if mode not in SAMPLE_RETENTION:
        raise ValueError(f"retention mode must be one of {sorted(SAMPLE_RETENTION)}, not {mode!r}")
    return as_of - SAMPLE_RETENTION[mode]


def expire(df: DataFrame, mode: str, as_of: datetime, column: str = "sample_time") -> DataFrame:
    """Rows not older than the mode keeps; with a ``sample_date`` partition column, older partitions are not read."""
    return in_range(df, start=cutoff(mode, as_of), column=column)


def expire_by_snapshot(
    df: DataFrame,
    snapshots: DataFrame,
    mode: str,
    as_of: datetime,
    inst_col: str = "inst_id",
    salt_on: Sequence[str] | None = None,
    keep: timedelta | None = None,
) -> DataFrame:
    """Rows whose snapshot is not among the expired ones; rows of unregistered snapshots are kept.

    SQL statistics and event histograms live as long as samples do: give ``keep=SAMPLE_RETENTION[mode]`` for them.
    """
    if mode not in SNAPSHOT_RETENTION_DAYS:
        raise ValueError(f"retention mode must be one of {sorted(SNAPSHOT_RETENTION_DAYS)}, not {mode!r}")
    limit = timestamp_lit(as_of - (keep or timedelta(days=SNAPSHOT_RETENTION_DAYS[mode])))
    expired = snapshots.where(F.col("hist_date") < limit).select(
        F.col("hist_sample_id").alias("snap_id"), "dbid", F.col("instance_number").alias(inst_col)
    )
    return lookup(df, expired, ["dbid", inst_col, "snap_id"], "left_anti", salt_on).select(*df.columns)
