from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        # literal test frames count as small, as stored tables of their size would
        "spark.sql.defaultSizeInBytes": "2000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    builder = SparkSession.builder.master("local[8]").appName("waitlens-tests")
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark):
    """No broadcast anywhere, so that the salted shuffle joins run."""
    settings = {
        "spark.waitlens.broadcastBytes": "-1",
        "spark.waitlens.joinSalts": "3",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(params=["broadcast", "shuffled"])
def either(request, spark):
    """Runs a test with both kinds of join."""
    return request.getfixturevalue("shuffled") if request.param == "shuffled" else spark


def at(text: str) -> datetime:
    """'1 10:00:05' is that time on a day of January 2024."""
    day, clock = text.split()
    return datetime.fromisoformat(f"2024-01-{int(day):02d} {clock}")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples of the given columns, or of all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


EVENTS = "dbid long, event_no long, event_id long, name string, wait_class string, wait_class_id long"
SAMPLES = (
    "dbid long, inst_id long, sample_id long, sample_time timestamp, session_id long, session_state string,"
    " session_type long, event_no long, sql_id string, sql_plan_hash_value long, current_obj long, ksuseblocker long"
)


def event_names(spark) -> DataFrame:
    return spark.createDataFrame(
        [
            (1, 1, 101, "read", "User I/O", 11),
            (1, 2, 102, "lock", "Concurrency", 12),
            (1, 3, 103, "odd", None, 13),
            (1, 4, 104, "sleep", "Idle", 14),
            (2, 1, 101, "read", "System I/O", 11),
        ],
        EVENTS,
    )


def sample(when: str, **values) -> tuple:
    row = {
        "dbid": 1,
        "inst_id": 1,
        "sample_id": 1,
        "sample_time": at(when),
        "session_id": 1,
        "session_state": "WAITING",
        "session_type": 1,
        "event_no": 1,
        "sql_id": "a",
        "sql_plan_hash_value": 0,
        "current_obj": 1,
        "ksuseblocker": 4294967291,
    }
    row.update(values)
    return tuple(row.values())


def samples(spark, *given: tuple) -> DataFrame:
    return spark.createDataFrame(list(given), SAMPLES)
