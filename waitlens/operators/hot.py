"""Working sets of hot SQL and objects, and what of them is not stored yet."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.constants import HOT_OBJECT_ROWS, HOT_SQL_ROWS, SNAPSHOT_MINUTES, SQLSTAT_DELTAS, SQLSTAT_OTHER
from waitlens.operators.joins import lookup
from waitlens.operators.times import recent

Target = tuple[int, int]

SQLSTAT_KEYS = ("dbid", "instance_number", "sql_id", "plan_hash_value")


def hot_sql(
    samples: DataFrame,
    as_of: datetime,
    span: timedelta = timedelta(minutes=SNAPSHOT_MINUTES),
    n: int = HOT_SQL_ROWS,
    target: Target | None = None,
) -> DataFrame:
    """The ``n`` most sampled (sql_id, plan) of each target, or of one."""
    rows = recent(samples, as_of, span).where(F.col("sql_id") != "0")
    if target is not None:
        rows = rows.where((F.col("dbid") == target[0]) & (F.col("inst_id") == target[1]))
    counts = rows.groupBy("dbid", "inst_id", "sql_id", "sql_plan_hash_value").agg(F.count("*").alias("cnt"))
    order = [F.desc("cnt"), F.asc("sql_id"), F.asc("sql_plan_hash_value")]
    if target is not None:
        return counts.orderBy(*order).limit(n)
    # row_number below a bound is cut to n rows per target before the shuffle as well
    ranked = counts.withColumn("rn", F.row_number().over(Window.partitionBy("dbid", "inst_id").orderBy(*order)))
    return ranked.where(F.col("rn") <= n).drop("rn")


def sql_variants(samples: DataFrame, sql_id: str, target: Target | None = None) -> DataFrame:
    """Every plan sampled for one statement."""
    rows = samples.where(F.col("sql_id") == sql_id)
    if target is not None:
        rows = rows.where((F.col("dbid") == target[0]) & (F.col("inst_id") == target[1]))
    return rows.select("dbid", "inst_id", "sql_id", "sql_plan_hash_value").distinct()


def new_objects(
    samples: DataFrame,
    objects: DataFrame,
    stored: DataFrame,
    as_of: datetime,
    span: timedelta = timedelta(hours=1),
    n: int = HOT_OBJECT_ROWS,
) -> DataFrame:
    """Objects among the ``n`` most sampled of the last ``span`` that are not stored for their database."""
    rows = recent(samples, as_of, span).where(F.col("current_obj") > 0)
    counts = rows.groupBy(F.col("current_obj").alias("object_id")).agg(F.count("*").alias("cnt"))
    hot = counts.orderBy(F.desc("cnt"), F.asc("object_id")).limit(n).select("object_id")
    # n rows at most, whatever the samples hold
    found = objects.join(F.broadcast(hot), ["object_id"], "left_semi")
    return lookup(found, stored, ["dbid", "object_id"], "left_anti")


def new_sql_text(hot: DataFrame, source: DataFrame, stored: DataFrame) -> DataFrame:
    """One text per hot statement that has none stored for its database; the smallest where variants differ."""
    keys = ["dbid", "sql_id"]
    wanted = lookup(source, hot.select(*keys).distinct(), keys, "left_semi")
    missing = lookup(wanted, stored, keys, "left_anti")
    return missing.groupBy(*keys).agg(F.min("sql_text").alias("sql_text"))


def new_plan_lines(hot: DataFrame, source: DataFrame, stored: DataFrame) -> DataFrame:
    """Lines of hot plans that are not stored for their database and instance."""
    keys = ["dbid", "inst_id", "sql_id", "plan_hash_value"]
    plans = hot.withColumnRenamed("sql_plan_hash_value", "plan_hash_value").select(*keys).distinct()
    wanted = lookup(source, plans, keys, "left_semi", ["id"])
    return lookup(wanted, stored, keys, "left_anti", ["id"])


def hot_sqlstats(
    hot: DataFrame, source: DataFrame, columns: Sequence[str] = (*SQLSTAT_DELTAS, *SQLSTAT_OTHER)
) -> DataFrame:
    """Counters of hot (sql, plan); counters the host does not have are 0."""
    keys = list(SQLSTAT_KEYS)
    plans = hot.select(
        "dbid",
        F.col("inst_id").alias("instance_number"),
        "sql_id",
        F.col("sql_plan_hash_value").alias("plan_hash_value"),
    )
    rows = lookup(source, plans.distinct(), keys, "left_semi")
    absent = {name: F.lit(0).cast("bigint") for name in columns if name not in rows.columns}
    lead = [name for name in ("snap_id", *keys) if name in rows.columns]
    return rows.withColumns(absent).select(*lead, *columns)
