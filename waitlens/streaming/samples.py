"""Sample ingest and windowed activity as streams."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waitlens.functions import timestamp_lit
from waitlens.operators.history import session_history
from waitlens.operators.ingest import flagged_stats, metric_increment
from waitlens.operators.joins import lookup
from waitlens.operators.reports import class_or_cpu
from waitlens.schemas import SAMPLES
from waitlens.sources.snapshots import SnapshotStore
from waitlens.sources.store import PARTITIONS, append_missing, exists, folders, materialise, remove, replace_partitions
from waitlens.sources.tables import conform

SAMPLE_KEY = ("dbid", "inst_id", "sample_id", "session_id")


def read_sample_stream(
    spark: SparkSession, path: str, schema: T.StructType = SAMPLES, max_files: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """New files under ``path`` as they arrive, at most ``max_files`` per batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return conform(reader.load(path))


def deduplicate(stream: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = SAMPLE_KEY) -> DataFrame:
    """Drop replayed samples of a stream that is only looked at: rows later than ``delay`` go, so it is not for stores."""
    return stream.withWatermark("sample_time", delay).dropDuplicatesWithinWatermark(list(keys))


def enrich(stream: DataFrame, event_names: DataFrame, **options) -> DataFrame:
    """The session history of a stream: a join with the static event names."""
    return session_history(stream, event_names, **options)


def _each_batch(rows: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str, every: str | None, mode: str = "append") -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = rows.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def ingest_samples(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = SAMPLE_KEY, every: str | None = None
) -> StreamingQuery:
    """Add samples to the store that ``store.write_samples``, ``read_samples`` and ``drop_expired`` share.

    Each batch appends what is not stored yet, so replayed files and repeated batches add nothing, and late samples are
    stored like others. No state is kept. A busy target's rows are written by as many tasks as they need. ``every`` is
    the batch interval; without it, what has arrived is taken and the query ends.
    """
    return _each_batch(stream, lambda batch, _: append_missing(batch, path, keys), checkpoint, every)


def ingest_counters(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    stat_names: DataFrame | None = None,
    io_events: Sequence[str] | None = None,
    every: str | None = None,
    partitions: Sequence[str] = PARTITIONS,
    keys: Sequence[str] | None = None,
) -> StreamingQuery:
    """Append instance counters as they arrive, by database and day of ``sample_time`` unless told otherwise.

    ``stat_names`` keeps the statistics flagged for collection, ``io_events`` the events of that list. Replayed rows, alike
    in ``keys`` or, without these, in all columns, add nothing.
    """
    rows = stream
    if stat_names is not None:
        rows = flagged_stats(rows, stat_names)
    if io_events is not None:
        rows = rows.where(F.col("event").isin(list(io_events)))
    own = list(keys or rows.columns)
    return _each_batch(rows, lambda batch, _: append_missing(batch, path, own, partitions), checkpoint, every)


def write_windows(counts: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the windows that each batch changed, the open ones as well, as they stand then; ``read_windows`` reads them.

    A repeated batch replaces its own rows. A new checkpoint counts its batches from 0, so it must not go on with an old path.
    """
    spark = counts.sparkSession
    if exists(spark, path) and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} holds the windows of another checkpoint")

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch", F.lit(number).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return _each_batch(counts, store, checkpoint, every, "update")


def _last_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    by = ["bucket_time", *keys]
    values = [c for c in rows.columns if c not in (*by, "batch")]
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*values, "batch"), F.col("batch")).alias("last"))
    return last.select(*by, "last.*")


def _closed(path: str) -> str:
    return f"{path.rstrip('/')}-closed"


def read_windows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Of each window and key the row of the last batch that changed it."""
    rows = spark.read.parquet(path)
    if exists(spark, _closed(path)):
        rows = rows.unionByName(spark.read.parquet(_closed(path)).drop("day"))
    return _last_of(rows, keys).drop("batch")


def compact_windows(spark: SparkSession, path: str, keys: Sequence[str], closed_before: datetime) -> None:
    """Bring the windows that ended in batches of their own together, so that files and reads do not grow with the batches.

    Windows before ``closed_before``, which the stream's watermark has passed, go to partitions by day; the others into one
    batch. The newest batch is left alone, as it may be repeated. A reader sees the same windows at any moment, and after a
    failure in between: rows keep their batch number, and of several the last counts.
    """
    batches = sorted(int(f.rsplit("=", 1)[1]) for f in folders(spark, f"{path}/batch=*"))[:-1]
    if not batches:
        return
    old = _last_of(spark.read.parquet(path).where(F.col("batch") <= batches[-1]), keys)
    old = materialise(old.withColumn("day", F.to_date("bucket_time")))
    over = F.col("bucket_time") < timestamp_lit(closed_before)
    closed = old.where(over)
    if exists(spark, _closed(path)):
        stored = spark.read.parquet(_closed(path))
        days = closed.select("day").distinct()
        touched = lookup(stored, days, ["day"], "left_semi", ["bucket_time"]).select(closed.columns)
        closed = _last_of(touched.unionByName(closed), [*keys, "day"]).select(closed.columns)
    replace_partitions(materialise(closed), _closed(path), ["day"], ["bucket_time"])
    open_rows = old.where(~over).drop("day").withColumn("batch", F.lit(batches[-1]).cast("bigint"))
    # an empty result replaces nothing, so the last of the old batches goes by itself then
    replace_partitions(open_rows, path, ["batch"], ["bucket_time"])
    gone = batches[:-1] if not open_rows.isEmpty() else batches
    for number in gone:
        remove(spark, f"{path}/batch={number}")


def counts_by_window(history: DataFrame, keys: Mapping[str, Column | str], seconds: int, delay: str = "10 minutes") -> DataFrame:
    """Number of samples ``n`` per window and key; in update mode (``write_windows``) open windows are given as well."""
    grouping = [(F.expr(e) if isinstance(e, str) else e).alias(k) for k, e in keys.items()]
    windows = F.window("sample_time", f"{seconds} seconds")
    counts = history.withWatermark("sample_time", delay).groupBy(windows, *grouping).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("bucket_time"), *keys, "n")


def activity_by_window(history: DataFrame, seconds: int = 15, delay: str = "10 minutes", sample_interval_s: int = 1) -> DataFrame:
    """Average active sessions per window and wait class."""
    counts = counts_by_window(history, {"wait_class": class_or_cpu()}, seconds, delay)
    return counts.select("bucket_time", "wait_class", (F.col("n") / (seconds / sample_interval_s)).alias("cnt"))


def ingest_metrics(
    stream: DataFrame,
    store: SnapshotStore,
    names: DataFrame,
    as_of: datetime,
    checkpoint: str,
    table: str = "metric_history",
    every: str | None = None,
) -> StreamingQuery:
    """Add metric rows to the snapshot store, each batch as a run that also moves the load marks of its targets.

    A batch takes what is later than its targets' marks, so overlapping files add nothing twice; a batch that comes again
    after its commit is left out. Batches are numbered as snapshots, so the stream needs a store of its own.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def load(batch: DataFrame, number: int) -> None:
        run = f"{name}-{number}"
        if store.committed(run):
            return
        rows = metric_increment(batch.distinct(), None, names, as_of, marks=store.marks(table))
        writer = store.begin(run)
        written = writer.write(table, rows.withColumn("snap_id", F.lit(number).cast("bigint")), mark="begin_time")
        keys = [F.col("snap_id").alias("hist_sample_id"), "dbid", F.col("inst_id").alias("instance_number")]
        writer.commit(written.groupBy(*keys).agg(F.max("begin_time").alias("hist_date")))

    return _each_batch(stream, load, checkpoint, every)
