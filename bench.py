"""Times the headline queries: median of three warm runs each, after a round to warm up; every row is produced.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demo import registry
from demo.fixtures import Tables
from waitlens.operators import reports

HEADLINE = (
    "top_sql_by_wait_class",
    "db_time_by_sql",
    "top_sessions",
    "activity_graph",
    "history_by_snapshot",
    "metric_summary",
    "counter_delta",
    "hot_sql",
    "session_history",
    "active_session_filter",
    "block_to_segment",
    "target_coverage",
)
COPIES = 100
RUNS = 3


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("waitlens-bench")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def top_sql_on_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship report on every sample taken a hundred times, to show how it scales."""
    tables = Tables(spark, sf_dir)
    samples = tables.samples(registry.TOP_START, registry.TOP_STOP)
    copies = samples.repartition(spark.sparkContext.defaultParallelism).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    )
    return reports.top_sql_by_wait_class(
        copies, registry.TOP_START, registry.TOP_STOP, event_names=tables.event_names()
    )


def measure(run) -> float:
    def once() -> float:
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    return statistics.median([once() for _ in range(RUNS + 1)][1:])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = session(cpus)
    known = registry.queries()
    runs = {name: partial(known[name], spark, sf_dir) for name in HEADLINE}
    runs["top_sql_by_wait_class_x100"] = partial(top_sql_on_copies, spark, sf_dir)
    for run in runs.values():
        measure(run)
    seconds = {name: round(measure(run), 4) for name, run in runs.items()}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
