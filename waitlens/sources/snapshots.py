"""The repository of snapshots: the rows of a run become visible together, by one commit that is written last.

Below the store's folder lie

* ``data/<table>/run=…/snap_id=…``: the rows that a run wrote, sorted by target;
* ``last/<run>``: the last values of counters as they stood after that run, in hash buckets of the entity;
* ``commits``: one file for each run, with its snapshots, its load marks and the tables it wrote.

Readers join the commits, so a run that broke off shows nothing, and its repetition is a run of its own. The join is on the
partition columns, so only the folders of the snapshots asked for are read (dynamic partition pruning). A store has one
writer at a time; readers may be many.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.functions import timestamp_lit
from waitlens.operators.delta import ENTITY, TARGET
from waitlens.operators.joins import lookup
from waitlens.operators.times import in_range
from waitlens.sources.store import exists, folders, materialise, remove

RUN, SNAPSHOT, MARK, LAST, TABLE = "run", "snapshot", "mark", "last", "table"
BUCKETS = 64

#: A commit's rows: its snapshots (target, number, time), its marks (table, target, newest time), its tables.
COMMITS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("dbid", T.LongType()),
        T.StructField("instance_number", T.LongType()),
        T.StructField("snap_id", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)
_PARTITIONS = [T.StructField("run", T.StringType()), T.StructField("snap_id", T.LongType())]


def instance_column(columns: Sequence[str]) -> str:
    """Tables name the instance either way."""
    return "instance_number" if "instance_number" in columns else "inst_id"


class SnapshotStore:
    """``schemas`` gives the columns of the tables by name; tables without one are read with the schema of their files."""

    def __init__(self, spark: SparkSession, path: str, schemas: Mapping[str, T.StructType] | None = None) -> None:
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), dict(schemas or {})

    # commits

    def commits(self) -> DataFrame:
        path = f"{self.path}/commits"
        return self.spark.read.schema(COMMITS).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], COMMITS)

    def snapshots(
        self, start: datetime | None = None, stop: datetime | None = None, target: tuple[int, int] | None = None
    ) -> DataFrame:
        """The registry: run, hist_sample_id, dbid, instance_number, hist_date of committed snapshots; both ends count."""
        rows = in_range(self.commits().where(F.col("kind") == SNAPSHOT), start, stop, "at")
        if target is not None:
            rows = rows.where((F.col("dbid") == target[0]) & (F.col("instance_number") == target[1]))
        named = rows.select("run", F.col("snap_id").alias("hist_sample_id"), "dbid", "instance_number", F.col("at").alias("hist_date"))
        return named.distinct()

    def compact_commits(self) -> int:
        """Bring the commits of all runs so far into one file; gives how many files that replaces.

        The new file is there before the old ones go, and a row that is there twice counts once, so readers see no difference,
        nor does a failure in between.
        """
        old = folders(self.spark, f"{self.path}/commits/*.parquet")
        if len(old) > 1:
            rows = self.spark.read.schema(COMMITS).parquet(*old).distinct()
            rows.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
            for file in old:
                remove(self.spark, file)
        return len(old)

    def _next(self) -> int:
        return (self.commits().agg(F.max("seq")).first()[0] or 0) + 1

    def committed(self, run: str) -> bool:
        return not self.commits().where(F.col("run") == run).isEmpty()

    def begin(self, run: str | None = None) -> Run:
        """A new run; with a name, as a repeated batch has, one that must not have been committed yet."""
        if run is not None and self.committed(run):
            raise ValueError(f"run {run} is committed already")
        return Run(self, run or uuid.uuid4().hex)

    # rows

    def _all(self, table: str) -> DataFrame:
        path = f"{self.path}/data/{table}"
        schema = self.schemas.get(table)
        if schema is None:
            return self.spark.read.parquet(path).withColumn("run", F.col("run").cast("string")).withColumn("snap_id", F.col("snap_id").cast("bigint"))
        own = [f for f in schema.fields if f.name not in ("run", "snap_id")]
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], T.StructType([*own, *_PARTITIONS]))
        return self.spark.read.schema(T.StructType([*own, *_PARTITIONS])).parquet(path)

    def _of(self, table: str, snapshots: DataFrame, by_target: bool) -> DataFrame:
        """Rows of the given snapshots; the registry's few rows decide which folders are read."""
        rows = self._all(table)
        folders = snapshots.select("run", F.col("hist_sample_id").alias("snap_id")).distinct()
        found = lookup(rows, folders, ["run", "snap_id"], "left_semi")
        if by_target:
            inst = instance_column(rows.columns)
            keys = snapshots.select("run", F.col("hist_sample_id").alias("snap_id"), "dbid", F.col("instance_number").alias(inst))
            others = [c for c in ("sql_id", "function_id", "event_no", "metric_id") if c in rows.columns]
            found = lookup(found, keys, ["run", "snap_id", "dbid", inst], "left_semi", others)
        return found.select(*[c for c in rows.columns if c != "run"])

    def read(
        self, table: str, start: datetime | None = None, stop: datetime | None = None, target: tuple[int, int] | None = None
    ) -> DataFrame:
        """Rows of all committed snapshots taken between ``start`` and ``stop``, both ends included."""
        rows = self._of(table, self.snapshots(start, stop, target), by_target=False)
        if target is None:
            return rows
        return rows.where((F.col("dbid") == target[0]) & (F.col(instance_column(rows.columns)) == target[1]))

    def latest(self, table: str, target: tuple[int, int] | None = None, as_of: datetime | None = None) -> DataFrame:
        """Rows of the newest snapshot of each target."""
        newest = self.snapshots(None, as_of, target).groupBy("dbid", "instance_number")
        newest = newest.agg(F.max(F.struct("hist_sample_id", "run")).alias("newest"))
        chosen = newest.select("dbid", "instance_number", "newest.*").where("hist_sample_id > -9223372036854775808")
        return self._of(table, chosen, by_target=True)

    def newest(self, table: str) -> DataFrame:
        """Rows that the newest run wrote, for tables that every run writes whole."""
        written = self.commits().where((F.col("kind") == TABLE) & (F.col("table_name") == table))
        last = written.agg(F.max_by("run", "seq")).scalar()
        rows = self._all(table)
        return rows.where(F.col("run") == last).select(*[c for c in rows.columns if c not in ("run", "snap_id")])

    # state

    def marks(self, table: str) -> DataFrame:
        """How far ``table`` is loaded, by target: dbid, inst_id, mark. No loaded row is read."""
        rows = self.commits().where((F.col("kind") == MARK) & (F.col("table_name") == table))
        return rows.groupBy("dbid", F.col("instance_number").alias("inst_id")).agg(F.max("at").alias("mark"))

    def last_values(self, table: str = "sqlstats") -> DataFrame | None:
        """Counters as they stood at each target's newest snapshot, in buckets of the entity; None before the first run."""
        newest = self._newest_last(table)
        return newest and bucketed(self.spark, f"{self.path}/last/{table}/{newest['run']}", newest["buckets"])

    def _newest_last(self, table: str) -> Row | None:
        kept = self.commits().where((F.col("kind") == LAST) & (F.col("table_name") == table))
        newest = kept.agg(F.max(F.struct("seq", "run", F.col("snap_id").alias("buckets"))).alias("m")).select("m.*").first()
        return newest if newest["run"] is not None else None

    def expire(self, keep_from: datetime, tables: Sequence[str]) -> list[str]:
        """Delete from ``tables`` the rows of snapshots taken before ``keep_from``, what runs left that were never committed, and
        last values that newer ones replace; gives the folders deleted. A folder that holds targets of both sides of the limit
        is written anew. No run may be under way."""
        limit = timestamp_lit(keep_from)
        known = self.snapshots()
        spans = known.groupBy("run", "hist_sample_id").agg((F.max("hist_date") < limit).alias("whole"), (F.min("hist_date") < limit).alias("part"))
        old = {(r["run"], r["hist_sample_id"]): r["whole"] for r in spans.where("part").toLocalIterator()}
        runs = {r["run"] for r in self.commits().select("run").distinct().toLocalIterator()}
        dropped = []
        for table in tables:
            for folder in folders(self.spark, f"{self.path}/data/{table}/run=*/snap_id=*"):
                run, snap = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
                if run not in runs or old.get((run, int(snap))):
                    remove(self.spark, folder)
                    dropped.append(folder)
                elif (run, int(snap)) in old:
                    rows = self.spark.read.parquet(folder)
                    inst = instance_column(rows.columns)
                    kept = known.where((F.col("run") == run) & (F.col("hist_sample_id") == int(snap)) & (F.col("hist_date") >= limit))
                    kept = kept.select("dbid", F.col("instance_number").alias(inst))
                    materialise(rows.join(kept, ["dbid", inst], "left_semi").select(rows.columns)).write.mode("overwrite").parquet(folder)
            newest = self._newest_last(table)
            for folder in folders(self.spark, f"{self.path}/last/{table}/*"):
                if newest is None or folder.rsplit("/", 1)[1] != newest["run"]:
                    remove(self.spark, folder)
                    dropped.append(folder)
        return sorted(dropped)


class Run:
    """What one run writes. Nothing of it can be seen before ``commit``, and all of it afterwards."""

    def __init__(self, store: SnapshotStore, run: str) -> None:
        self.store, self.run, self.seq = store, run, store._next()
        self._rows: list[DataFrame] = []

    def _record(self, kind: str, rows: DataFrame | None = None, **values) -> None:
        """Adds commit rows; columns that ``rows`` lacks are set from ``values`` or null."""
        rows = self.store.spark.range(1).select() if rows is None else rows
        fixed = {"run": self.run, "seq": self.seq, "kind": kind} | values
        columns = [
            (F.lit(fixed[f.name]) if f.name in fixed else F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in COMMITS
        ]
        self._rows.append(rows.select(*columns))

    def write(self, table: str, rows: DataFrame, mark: str | None = None) -> DataFrame:
        """Write the rows of a table, which hold their ``snap_id``, and give them back as they are stored.

        ``mark`` names the time column that tells how far the table is loaded now; it is taken from the rows just written.
        """
        path = f"{self.store.path}/data/{table}/run={self.run}"
        order = [c for c in ("snap_id", "dbid", "inst_id", "instance_number") if c in rows.columns]
        rows.hint("rebalance", "snap_id").sortWithinPartitions(*order).write.mode("overwrite").partitionBy("snap_id").parquet(path)
        schema = T.StructType([*[f for f in rows.schema if f.name != "snap_id"], rows.schema["snap_id"]])
        written = self.store.spark.read.schema(schema).parquet(path)
        self._record(TABLE, table_name=table)
        if mark is not None:
            inst = F.col(instance_column(rows.columns)).alias("instance_number")
            self._record(MARK, written.groupBy("dbid", inst).agg(F.max(mark).alias("at")), table_name=table)
        return written

    def write_last(self, rows: DataFrame, table: str = "sqlstats", entity: Sequence[str] = ENTITY, buckets: int = BUCKETS) -> None:
        """Keep the counters of each target's newest snapshot for the next run."""
        write_bucketed(rows, f"{self.store.path}/last/{table}/{self.run}", entity, buckets)
        self._record(LAST, table_name=table, snap_id=buckets)

    def commit(self, snapshots: DataFrame | None = None) -> None:
        """Make the run visible. ``snapshots`` has hist_sample_id, dbid, instance_number and hist_date."""
        self._record(RUN)
        if snapshots is not None:
            named = snapshots.select(F.col("hist_sample_id").alias("snap_id"), "dbid", "instance_number", F.col("hist_date").alias("at"))
            self._record(SNAPSHOT, named)
        rows = self._rows[0]
        for more in self._rows[1:]:
            rows = rows.unionByName(more)
        # one small file, put in its place by one rename
        rows.coalesce(1).write.mode("append").parquet(f"{self.store.path}/commits")


def write_bucketed(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Rows as Parquet files by hash bucket of ``keys``, one file a bucket."""
    name = f"waitlens_{uuid.uuid4().hex}"
    spread = rows.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(name)
    rows.sparkSession.sql(f"drop table {name}")  # the files stay


def bucketed(spark: SparkSession, path: str, buckets: int, keys: Sequence[str] = ENTITY) -> DataFrame:
    """The rows of ``write_bucketed``, of which joins on ``keys`` need no shuffle."""
    schema = spark.read.parquet(path).schema
    name, by = f"waitlens_{uuid.uuid4().hex}", ", ".join(keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


def advance(
    now: DataFrame,
    last: DataFrame | None,
    snapshots: DataFrame,
    columns: Mapping[str, str],
    entity: Sequence[str] = ENTITY,
    on_reset: str = "keep",
) -> tuple[DataFrame, DataFrame]:
    """The rows of a new snapshot with the change of each counter since the target's previous one, and the next last values.

    ``last`` holds the rows of each target's previous snapshot, in buckets of the entity, none of which has a null key; only
    ``now`` is shuffled. An entity that is not in ``last`` was absent then, so its changes are null. ``snapshots`` (dbid,
    instance_number) are the targets of this run: their last values are replaced, also where they have no rows now; others stay.
    """
    entity, counters = list(entity), list(columns)
    values = now.select(*entity, "snap_id", *counters)
    if last is None:
        changes = {d: F.lit(None).cast(now.schema[c].dataType) for c, d in columns.items()}
        return now.withColumns(changes), values
    earlier = last.select(*[F.col(k).alias(f"__{k}") for k in entity], F.col("snap_id").alias("__snap"), *[F.col(c).alias(f"__{c}") for c in counters])
    both = now.withColumn("__now", F.lit(True)).join(earlier, [F.col(k) == F.col(f"__{k}") for k in entity], "full_outer")
    changes = {}
    for counter, name in columns.items():
        change = F.col(counter) - F.col(f"__{counter}")
        changes[name] = F.when(change >= 0, change) if on_reset == "null" else change
    rows = both.where("__now").withColumns(changes).select(*now.columns, *columns.values())
    silent = both.where("__now is null").select(
        *[F.col(f"__{k}").alias(k) for k in entity], F.col("__snap").alias("snap_id"), *[F.col(f"__{c}").alias(c) for c in counters]
    )
    others = lookup(silent, snapshots.select(*TARGET).distinct(), list(TARGET), "left_anti", ["sql_id"])
    return rows, values.unionByName(others.select(values.columns))
