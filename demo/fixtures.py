"""The repository's input tables, derived from the driver tables by Spark."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.constants import IO_EVENT_NAMES, SQLSTAT_DELTAS
from waitlens.sources import conform

# ids 1 + x % 3 for whole numbers x: the databases every derivation yields
ALL_DBIDS = "array(1L, 2L, 3L)"
BIG = "bigint"

SAMPLE_COLUMNS = (
    "1 + user_id % 3 as dbid",
    "1 + (event_id % 4) % 2 as inst_id",
    "event_id as sample_id",
    "date_trunc('second', ts) as sample_time",
    "user_id as session_id",
    "user_id % 20 as user_id",
    "case when event_type = 'purchase' then 'ON CPU' else 'WAITING' end as session_state",
    "case user_id % 10 when 0 then 17L when 1 then 2L when 2 then 4L else 1L end as session_type",
    "event_id % 26 as event_no",
    "case when event_id % 11 = 0 then null when event_id % 13 = 0 then '0'"
    " else concat('q', cast(cast(floor(value) as bigint) % 40 as string)) end as sql_id",
    "event_id % 3 as sql_plan_hash_value",
    "event_id % 8 as sql_opcode",
    "event_id % 100 as p1",
    "event_id % 7 as p2",
    "user_id as p3",
    "cast(floor(value * 1000) as bigint) as time_waited",
    "user_id as current_obj",
    "1 + event_id % 4 as current_file",
    "(event_id * 37) % 4096 as current_block",
    "concat('prog', cast(user_id % 5 as string)) as program",
    "event_type as module",
    "case when event_id % 17 = 0 then user_id end as qc",
    "case event_id % 8 when 0 then 4294967295 when 1 then 4294967292 when 2 then 4294967291"
    " else 65536 * (1 + user_id % 2) + event_id % 150 end as ksuseblocker",
)
RAW_COLUMNS = (
    "event_id % 2 as ksspaflg",
    "event_id % 16 as ksuseidl",
    "event_id % 5 as ksusetim",
    "case when event_id % 9 = 0 then 4294967293 else 262144 * (1 + event_id % 3) + event_id % 500 end as ksusefblocker",
    "(event_id % 4) * 1024 as ksusstmbv",
    "case when event_id % 9 = 0 then 65535L else event_id % 4 end as sql_child_number",
    "event_id % 6 as sql_exec_id",
    "event_id % 5 as plsql_entry_object_id",
    "event_id % 3 as plsql_entry_subprogram_id",
    "event_id % 7 as plsql_object_id",
    "event_id % 4 as plsql_subprogram_id",
)

_SCHEMAS: dict[str, T.StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _dbid(key: str) -> Column:
    return (F.col(key) % 3 + 1).cast(BIG).alias("dbid")


def _int_div(col: Column, by: int) -> Column:
    return F.floor(col / by).cast(BIG)


def _month_no(day: str) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast(BIG)


class Tables:
    """Input tables of one scale factor, each read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def load(self, name: str) -> DataFrame:
        return load(self.spark, self.dir, name)

    def events(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Events, with the time range stated on the stored column so that it reaches the scan."""
        rows = self.load("events")
        kind = rows.schema["ts"].dataType
        if since is not None:
            rows = rows.where(F.col("ts") >= F.lit(since.isoformat(sep=" ")).cast(kind))
        if until is not None:
            end = until + timedelta(seconds=1)
            rows = rows.where(F.col("ts") < F.lit(end.isoformat(sep=" ")).cast(kind))
        return conform(rows)

    def samples(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        return self.events(since, until).selectExpr(*SAMPLE_COLUMNS)

    def sample_stream(self, max_files: int | None = None) -> DataFrame:
        """The samples as a stream of the event files."""
        reader = self.spark.readStream.schema(self.load("events").schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return conform(reader.parquet(f"{self.dir}/events*.parquet")).selectExpr(*SAMPLE_COLUMNS)

    def raw_sessions(self) -> DataFrame:
        """Session rows as the host shows them, before filtering and decoding."""
        raw = self.events().selectExpr(*SAMPLE_COLUMNS, *RAW_COLUMNS)
        renamed = {"session_type": "ksuseflg", "event_no": "ksuseopc"}
        return raw.drop("session_state", "sample_id").withColumnsRenamed(renamed)

    def event_names(self) -> DataFrame:
        return self.load("nation").selectExpr(
            f"explode({ALL_DBIDS}) as dbid",
            "cast(n_nationkey as bigint) as event_no",
            "cast(n_nationkey + 5000 as bigint) as event_id",
            "n_name as name",
            "case when n_nationkey = 24 then null when n_regionkey = 0 then 'User I/O' when n_regionkey = 1 then 'System I/O'"
            " when n_regionkey = 2 then 'Concurrency' when n_regionkey = 3 then 'Application' else 'Idle' end as wait_class",
            "cast(1000 + n_regionkey as bigint) as wait_class_id",
        )

    def wait_groups(self) -> DataFrame:
        """Class by event name; the names of one region are missing and some classes carry a line end."""
        classes = F.array(*[F.lit(c) for c in ("Network", "Commit", "Configuration\n", "Other")])
        rows = self.load("nation").where("n_regionkey <> 4")
        return rows.select(
            F.col("n_name").alias("name"), F.element_at(classes, (F.col("n_nationkey") % 4 + 1).cast("int")).alias("wait_class")
        )

    def snapshots(self) -> DataFrame:
        return (
            self.events()
            .select(
                F.dayofmonth("ts").cast(BIG).alias("hist_sample_id"),
                _dbid("user_id"),
                (1 + (F.col("event_id") % 4) % 2).alias("instance_number"),
                F.date_trunc("day", "ts").alias("hist_date"),
            )
            .distinct()
        )

    def sqlstats(self) -> DataFrame:
        orders = conform(self.load("orders"))
        monthly = orders.groupBy(
            _month_no("o_orderdate").alias("snap_id"),
            _dbid("o_custkey"),
            F.concat(F.lit("q"), (F.col("o_custkey") % 50).cast("string")).alias("sql_id"),
        ).agg(
            F.count("*").alias("n"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast(BIG)).alias("cents"),
        )
        w = Window.partitionBy("dbid", "sql_id").orderBy("snap_id")
        return monthly.select(
            "snap_id",
            "dbid",
            F.lit(1).cast(BIG).alias("instance_number"),
            "sql_id",
            F.lit(0).cast(BIG).alias("plan_hash_value"),
            F.sum("n").over(w).alias("executions"),
            F.sum("cents").over(w).alias("elapsed_time"),
        )

    def sqlstats_wide(self) -> DataFrame:
        """All counters with a delta, of two instances; many statements are missing in some months."""
        orders = conform(self.load("orders"))
        amounts = [F.sum((F.col("o_orderkey") * (n + 1) + F.col("o_custkey")) % (97 + n)).alias(c) for n, c in enumerate(SQLSTAT_DELTAS)]
        monthly = orders.groupBy(
            _month_no("o_orderdate").alias("snap_id"),
            _dbid("o_custkey"),
            (F.col("o_custkey") % 2 + 1).cast(BIG).alias("instance_number"),
            F.concat(F.lit("q"), (F.col("o_custkey") % 50).cast("string")).alias("sql_id"),
        ).agg(*amounts)
        w = Window.partitionBy("dbid", "instance_number", "sql_id").orderBy("snap_id")
        sums = [F.sum(c).over(w).alias(c) for c in SQLSTAT_DELTAS]
        return monthly.select("snap_id", "dbid", "instance_number", "sql_id", F.lit(0).cast(BIG).alias("plan_hash_value"), *sums)

    def sqlstat_snapshots(self) -> DataFrame:
        """Registry of the monthly SQL-stat snapshots."""
        return self.sqlstats().select(F.col("snap_id").alias("hist_sample_id"), "dbid", "instance_number").distinct()

    def metric_history(self) -> DataFrame:
        return conform(self.load("lineitem")).select(
            _dbid("l_suppkey"),
            F.lit(1).cast(BIG).alias("inst_id"),
            _month_no("l_shipdate").alias("snap_id"),
            F.date_trunc("day", "l_shipdate").alias("begin_time"),
            F.when(F.col("l_linenumber") % 2 == 1, F.lit(6000)).otherwise(F.lit(1500)).cast(BIG).alias("intsize_csec"),
            F.lit(2).cast(BIG).alias("group_id"),
            (F.col("l_partkey") % 6).alias("metric_id"),
            F.col("l_quantity").alias("value"),
        )

    def metric_names(self) -> DataFrame:
        return self.load("region").select(
            F.expr(f"explode({ALL_DBIDS}) as dbid"),
            F.col("r_regionkey").cast(BIG).alias("metric_id"),
            F.col("r_name").alias("metric_name"),
            F.lit("Per Second").alias("metric_unit"),
        )

    def event_histogram(self) -> DataFrame:
        bounds = (1, 2, 4, 8, 16, 32, 64, 128, 256)
        milli = F.lit(512)
        for bound in reversed(bounds):
            milli = F.when(F.col("value") <= bound, F.lit(bound)).otherwise(milli)
        return (
            self.events()
            .groupBy(
                F.dayofmonth("ts").cast(BIG).alias("snap_id"),
                _dbid("user_id"),
                (F.col("event_id") % 26).alias("event_no"),
                milli.cast(BIG).alias("wait_time_milli"),
            )
            .agg(F.count("*").alias("wait_count"))
            .select("snap_id", "dbid", F.lit(1).cast(BIG).alias("inst_id"), "event_no", "wait_time_milli", "wait_count")
        )

    def iofuncstats(self) -> DataFrame:
        """The histogram by event, as counters of I/O functions."""
        return (
            self.event_histogram()
            .groupBy("dbid", F.col("inst_id").alias("instance_number"), "snap_id", F.col("event_no").alias("function_id"))
            .agg(F.sum("wait_count").alias("number_of_waits"), F.max("wait_time_milli").alias("wait_time"))
        )

    def time_model(self) -> DataFrame:
        return (
            self.event_histogram()
            .groupBy("snap_id", "dbid", "inst_id", F.col("event_no").alias("stat_id"))
            .agg(F.sum("wait_count").alias("value"))
        )

    def osstat(self) -> DataFrame:
        """Weighted waits by event, as operating-system statistics."""
        return (
            self.event_histogram()
            .groupBy("snap_id", "dbid", "inst_id", F.col("event_no").alias("osstat_id"))
            .agg(F.sum(F.col("wait_count") * F.col("wait_time_milli")).alias("value"))
        )

    def osstat_names(self) -> DataFrame:
        return self.event_names().select("dbid", F.col("event_no").alias("osstat_id"), F.col("name").alias("stat_name"))

    def latches(self) -> DataFrame:
        return self.load("region").select(
            F.expr(f"explode({ALL_DBIDS}) as dbid"), F.col("r_regionkey").cast(BIG).alias("latch_no"), F.col("r_name").alias("name")
        )

    def params(self) -> DataFrame:
        return self.load("nation").select(
            F.expr(f"explode({ALL_DBIDS}) as dbid"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("value")
        )

    def time_model_names(self) -> DataFrame:
        return self.event_names().select("dbid", F.col("event_no").alias("stat_id"), F.col("name").alias("stat_name"))

    def system_events(self) -> DataFrame:
        """Cumulative event counters; two of ten event names are not I/O events."""
        names = F.array(*[F.lit(n) for n in (*IO_EVENT_NAMES, "latch free", "buffer busy waits")])
        key = F.col("event_id") % 10
        return (
            self.events()
            .groupBy(
                _dbid("user_id"),
                (1 + (F.col("event_id") % 4) % 2).alias("inst_id"),
                F.element_at(names, (key + 1).cast("int")).alias("event"),
            )
            .agg(F.count("*").alias("total_waits"), F.sum(F.floor(F.col("value") * 1000).cast(BIG)).alias("time_waited_micro"))
        )

    def instance_stats(self) -> DataFrame:
        return (
            self.load("orders")
            .groupBy(_dbid("o_custkey"), (F.col("o_custkey") % 7).alias("statistic"))
            .agg(F.count("*").alias("value"))
            .select("dbid", F.lit(1).cast(BIG).alias("inst_id"), "statistic", "value")
        )

    def instance_stat_stream(self) -> DataFrame:
        """Single counter readings, as a stream of the order files."""
        orders = self.spark.readStream.schema(self.load("orders").schema).parquet(f"{self.dir}/orders*.parquet")
        return conform(orders).selectExpr(
            "1 + o_custkey % 3 as dbid",
            "1L as inst_id",
            "o_orderdate as sample_time",
            "o_custkey % 7 as statistic",
            "o_orderkey as value",
        )

    def stat_names(self) -> DataFrame:
        """Names of statistics 0..4, even ones to be collected."""
        return self.load("region").select(
            F.expr(f"explode({ALL_DBIDS}) as dbid"),
            F.col("r_regionkey").cast(BIG).alias("statistic"),
            F.col("r_name").alias("name"),
            (1 - F.col("r_regionkey") % 2).cast(BIG).alias("collect"),
        )

    def targets(self) -> DataFrame:
        found = self.events().select(_dbid("user_id"), (1 + (F.col("event_id") % 4) % 2).alias("inst_num")).distinct()
        silent = self.spark.range(1).select(F.lit(9).cast(BIG).alias("dbid"), F.lit(1).cast(BIG).alias("inst_num"))
        number = F.col("dbid").cast("string")
        return found.unionByName(silent).select(
            "dbid",
            F.concat(F.lit("host"), number).alias("host"),
            F.lit(1521).cast(BIG).alias("port"),
            F.concat(F.lit("db"), number).alias("dbname"),
            "inst_num",
        )

    def sqltext(self) -> DataFrame:
        sql_id = F.concat(F.lit("q"), (F.col("p_partkey") % 30).cast("string")).alias("sql_id")
        return self.load("part").groupBy(_dbid("p_partkey"), sql_id).agg(F.min("p_name").alias("sql_text"))

    def sqltext_by_plan(self) -> DataFrame:
        """Statement texts as the host lists them: one row per part, so several per statement."""
        sql_id = F.concat(F.lit("q"), (F.col("p_partkey") % 40).cast("string")).alias("sql_id")
        return self.load("part").select(_dbid("p_partkey"), sql_id, F.col("p_name").alias("sql_text"))

    def plan_lines(self) -> DataFrame:
        key, line = F.col("l_orderkey"), F.col("l_linenumber").cast(BIG)
        return (
            self.load("lineitem")
            .groupBy(
                F.concat(F.lit("q"), (key % 40).cast("string")).alias("sql_id"),
                (key % 3).alias("plan_hash_value"),
                (line - 1).alias("id"),
                (line - 2).alias("parent_id"),
                (line - 1).alias("depth"),
                _dbid("l_orderkey"),
                (1 + key % 2).alias("inst_id"),
            )
            .agg(
                F.concat(F.lit("OP_"), F.min("l_returnflag")).alias("operation"),
                F.concat(F.lit("OPT_"), F.min("l_linestatus")).alias("options"),
            )
        )

    def customers(self, condition: str = "true") -> DataFrame:
        """Customers, as users of the monitored databases."""
        return self.load("customer").where(condition).select(
            _dbid("c_custkey"), F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username")
        )

    def users(self) -> DataFrame:
        """The users that are stored already: customers that owe nothing."""
        return self.customers("c_acctbal >= 0")

    def objects(self) -> DataFrame:
        return self.load("part").select(
            _dbid("p_partkey"),
            F.col("p_partkey").alias("object_id"),
            F.col("p_name").alias("object_name"),
            F.col("p_type").alias("object_type"),
        )

    def data_files(self, condition: str = "true") -> DataFrame:
        return self.load("supplier").where(condition).select(
            _dbid("s_suppkey"),
            F.col("s_suppkey").alias("file_id"),
            F.col("s_name").alias("file_name"),
            F.concat(F.lit("ts"), F.col("s_nationkey").cast("string")).alias("tablespace_name"),
        )

    def extents(self) -> DataFrame:
        """Extents that do not overlap within a file, with gaps between them."""
        key = F.col("p_partkey")
        return self.load("part").select(
            _dbid("p_partkey"),
            (1 + key % 4).alias("file_id"),
            (16 * _int_div(key, 12)).alias("block_id"),
            (1 + F.col("p_size") % 16).cast(BIG).alias("blocks"),
            F.concat(F.col("p_name"), F.lit("_"), key.cast("string")).alias("segment_name"),
            F.col("p_type").alias("segment_type"),
        )
