"""Tables written once in the shared work folder, so that lineage is cut and a lost executor costs no recomputation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`; where that is unset, as in tests, a local session gets a folder of its own."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="waitlens-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, *partition_by: str, codec: str | None = None) -> DataFrame:
    """The rows of `frame`, written as Parquet and read back. codec: of the files, if not the session's."""
    path = work_folder(frame.sparkSession)
    frame.write.partitionBy(*partition_by).parquet(path, compression=codec)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
