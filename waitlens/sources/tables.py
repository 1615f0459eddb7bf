"""Reading input tables with the types the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitlens.schemas import WAIT_GROUPS


def conform(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become timestamps of the session time zone (watermarks need them)."""
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(casts) if casts else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A table in any file format Spark reads; formats without their own schema need ``schema``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return conform(reader.load(path))


def read_wait_groups(spark: SparkSession, path: str) -> DataFrame:
    """The event-name to wait-class lookup, a CSV file with header ``name,wait_class``."""
    return spark.read.schema(WAIT_GROUPS).csv(path, header=True, multiLine=True)
