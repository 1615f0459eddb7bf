"""Checks on the repository's own data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.functions import timestamp_lit


def target_coverage(targets: DataFrame, samples: DataFrame, as_of: datetime, max_gap: timedelta) -> DataFrame:
    """Every target with its number of samples, first and last sample, and whether sampling has stopped."""
    seen = samples.groupBy("dbid", F.col("inst_id").alias("inst_num")).agg(
        F.count("*").alias("samples"),
        F.min("sample_time").alias("first_sample"),
        F.max("sample_time").alias("last_sample"),
    )
    joined = targets.join(seen, ["dbid", "inst_num"], "left")
    stale = F.col("last_sample").isNull() | (F.col("last_sample") < timestamp_lit(as_of - max_gap))
    return joined.select(
        *targets.columns,
        F.coalesce("samples", F.lit(0).cast("bigint")).alias("samples"),
        "first_sample",
        "last_sample",
        stale.alias("stale"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > 1)
