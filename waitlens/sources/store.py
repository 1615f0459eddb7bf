"""The partitioned Parquet store of samples and snapshots."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.functions import timestamp_lit
from waitlens.operators.ingest import upsert
from waitlens.operators.joins import lookup
from waitlens.operators.retention import cutoff
from waitlens.operators.times import in_range

PARTITIONS = ("dbid", "sample_date")


def with_sample_date(samples: DataFrame) -> DataFrame:
    return samples.withColumn("sample_date", F.to_date("sample_time"))


def _balanced(df: DataFrame, partitions: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of one partition together, a partition that is too big for a task split, small ones merged."""
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *order)


def write_samples(samples: DataFrame, path: str, mode: str = "append") -> None:
    """Add samples to the store; ``mode="overwrite"`` replaces the (database, day) partitions the samples touch.

    Files are sorted by time, so that their row-group statistics narrow a time filter.
    """
    rows = _balanced(with_sample_date(samples), PARTITIONS, ["sample_time"])
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITIONS).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def _one_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    least = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("__least"))
    return least.select(*keys, "__least.*").select(rows.columns)


def append_missing(rows: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str] = PARTITIONS) -> None:
    """Append the rows whose keys, with ``sample_time``, are not stored yet; however late a row is, it is stored.

    A repeated batch therefore adds nothing. Only the keys of the days and the time span of ``rows`` are read. Of several rows with
    one key the least by its other columns is stored.
    """
    keys = list(dict.fromkeys([*keys, "sample_time"]))
    rows = _one_of_each(with_sample_date(rows), keys).persist()
    try:
        new = rows
        if exists(rows.sparkSession, path):
            span = rows.agg(F.min("sample_time"), F.max("sample_time"), F.collect_set("sample_date")).first()
            near = F.col("sample_date").isin(span[2]) & F.col("sample_time").between(span[0], span[1])
            stored = rows.sparkSession.read.schema(rows.schema).parquet(path).where(near | F.col("sample_date").isNull())
            stored = stored.select(*[F.col(k).alias(f"__{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            new = rows.join(stored, same, "left_anti")
        _balanced(new, partitions, ["sample_time"]).write.mode("append").partitionBy(*partitions).parquet(path)
    finally:
        rows.unpersist()


def read_samples(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    stop: datetime | None = None,
    target: tuple[int, int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Samples of a time range (both ends count) and target; only the partitions needed are read.

    With ``schema``, the columns of the samples, no file is opened to learn them.
    """
    reader = spark.read
    if schema is not None:
        own = [f for f in schema.fields if f.name not in PARTITIONS]
        reader = reader.schema(T.StructType([*own, T.StructField("dbid", T.LongType()), T.StructField("sample_date", T.DateType())]))
    rows = in_range(reader.parquet(path), start, stop)
    if target is not None:
        rows = rows.where((F.col("dbid") == target[0]) & (F.col("inst_id") == target[1]))
    return rows.withColumn("dbid", F.col("dbid").cast("bigint"))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    files, place = _place(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(place) or []]


def rewrite(rows: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()) -> None:
    """Put ``rows`` in the place of the partitions they were read from.

    They are copied to a work folder first, which a failure in between leaves whole; partitions that are left without rows are
    not touched.
    """
    replace_partitions(materialise(rows), path, partitions, order)


def drop_expired(spark: SparkSession, path: str, mode: str, as_of: datetime) -> list[str]:
    """Delete the day partitions that lie wholly before the retention limit; gives the deleted folders.

    The day that holds the limit stays; ``delete_expired`` shortens it as well, ``retention.expire`` leaves its older rows out.
    """
    first_kept, dropped = cutoff(mode, as_of).date().isoformat(), []
    for folder in folders(spark, f"{path}/dbid=*/sample_date=*"):
        if folder.rsplit("=", 1)[1] < first_kept:
            remove(spark, folder)
            dropped.append(folder)
    return sorted(dropped)


def delete_expired(spark: SparkSession, path: str, mode: str, as_of: datetime) -> list[str]:
    """Delete all samples that lie before the retention limit from the files; gives the deleted folders.

    Days wholly before it go as folders. The day that holds the limit is written anew without its older rows, once there
    are any, and only in the databases that have some; where none is left its folder goes too.
    """
    limit, dropped = cutoff(mode, as_of), drop_expired(spark, path, mode, as_of)
    day_name = f"sample_date={limit.date().isoformat()}"
    if not folders(spark, f"{path}/dbid=*/{day_name}"):
        return dropped
    day = spark.read.parquet(path).where(F.col("sample_date") == F.lit(limit.date().isoformat()).cast("date"))
    old = F.col("sample_time") < timestamp_lit(limit)
    holders = materialise(day.groupBy("dbid").agg(F.bool_or(old).alias("shrinks"), F.bool_and(old).alias("goes")).where("shrinks"))
    if holders.isEmpty():
        return dropped
    keeping = lookup(day.where(~old), holders, ["dbid"], "left_semi", ["sample_time"]).select(day.columns)
    rewrite(keeping, path, PARTITIONS, ["sample_time"])
    for row in holders.where("goes").toLocalIterator():
        folder = f"{path}/dbid={row['dbid']}/{day_name}"
        remove(spark, folder)
        dropped.append(folder)
    return sorted(dropped)


def merge_buckets(
    updates: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str], buckets: int = 64
) -> list[int]:
    """Merge ``updates`` into a dimension that is stored in hash buckets of its keys; gives the buckets written.

    Matched rows take ``update_cols``, unmatched updates are added. Only buckets in which that changes something are read whole
    and written anew, so a merge costs what it changes, and one that changes nothing writes nothing. Keys of ``updates``
    are unique.
    """
    spark, keys = updates.sparkSession, list(keys)
    updates = updates.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if not exists(spark, path):
        replace_partitions(updates, path, ["bucket"], keys)
        return list(range(buckets))
    stored = spark.read.schema(updates.schema).parquet(path)
    known = stored.select("bucket", *[F.col(c).alias(f"__{c}") for c in (*keys, *update_cols)], F.lit(True).alias("__known"))
    same = [known["bucket"] == updates["bucket"], *[updates[k].eqNullSafe(known[f"__{k}"]) for k in keys]]
    differs = F.col("__known").isNull()
    for column in update_cols:
        differs = differs | ~updates[column].eqNullSafe(known[f"__{column}"])
    changed = materialise(updates.join(known, same, "left").where(differs).select(*[updates[c] for c in updates.columns]))
    touched = sorted(r["bucket"] for r in changed.select("bucket").distinct().collect())  # as many as there are buckets
    if touched:
        base = stored.where(F.col("bucket").isin(touched))
        rewrite(upsert(base, changed, [*keys, "bucket"], update_cols), path, ["bucket"], keys)
    return touched


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()) -> None:
    """Write snapshot rows by partition; partitions that come again are replaced, so a repeated job adds nothing twice."""
    writer = _balanced(df, partitions, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def work_folder(spark: SparkSession) -> str:
    """Name of a new folder in the cluster's shared folder; a local one only where there is no cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="waitlens-")
    return f"{base.rstrip('/')}/waitlens-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """The rows written to a new work folder and read back.

    For a small set that several results need: it is computed once, survives lost executors, and its size is known to
    the optimizer from then on.
    """
    path = f"{work_folder(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_new(df: DataFrame, path: str) -> None:
    """Write a whole dimension to a folder that does not exist yet (a table is never written over while read)."""
    df.write.mode("errorifexists").parquet(path)
