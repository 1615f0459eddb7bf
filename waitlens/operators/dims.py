"""Dimension tables: names, texts, objects and files of the monitored databases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.constants import SQL_COMMAND_TYPE
from waitlens.operators.joins import lookup, range_lookup


def apply_wait_groups(event_names: DataFrame, wait_groups: DataFrame) -> DataFrame:
    """Set every event's class from the shared lookup by name; events it lacks get a null class.

    ``wait_groups`` (name, wait_class) has one row per name.
    """
    trimmed = F.regexp_replace("wait_class", r"^\s+|\s+$", "")
    groups = wait_groups.select("name", trimmed.alias("wait_class")).distinct()
    columns = event_names.columns
    remapped = lookup(event_names.drop("wait_class"), groups, ["name"], "left", ["dbid", "event_no"])
    return remapped.select(*columns)


def for_target(dim: DataFrame, dbid: int | None = None) -> DataFrame:
    """The dimension of one database, or of the whole fleet."""
    return dim if dbid is None else dim.where(F.col("dbid") == dbid)


def sql_list(sqltext: DataFrame, dbid: int | None = None) -> DataFrame:
    """Statements with their text in the host's column layout."""
    return for_target(sqltext, dbid).select("dbid", "sql_id", F.lit(SQL_COMMAND_TYPE).alias("command_type"), "sql_text")


def sql_text(sqltext: DataFrame, sql_id: str, dbid: int | None = None) -> DataFrame:
    """Text of one statement."""
    return sql_list(sqltext, dbid).where(F.col("sql_id") == sql_id)


def block_to_segment(
    samples: DataFrame, extents: DataFrame, columns: Sequence[str] = ("segment_name",), width: int = 1024
) -> DataFrame:
    """Add the segment whose extent holds the block a session was working on.

    Extents have no proven length, so nothing is broadcast up front; hot blocks are spread by session.
    """
    extents = extents.withColumnRenamed("file_id", "current_file")
    return range_lookup(
        samples,
        extents,
        ["dbid", "current_file"],
        point=F.col("current_block"),
        start=F.col("block_id"),
        stop=F.col("block_id") + F.col("blocks") - 1,
        width=width,
        salt_on=["session_id", "sample_id"],
        interval_columns=columns,
    )
