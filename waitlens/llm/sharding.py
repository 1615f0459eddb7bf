"""Cuts documents into contiguous shards of near equal bytes, by global prefix sums.

Documents are ordered by the digest of their text and their id, so equal texts stand together. A range partitioning of the
small rows (id, size, digest; no text) fixes each row's partition; they are written once. The partitions' totals, one row
each, are summed up in order, and with the sums inside each partition every document has its place in the global order of
bytes. A document belongs to the shard in which its middle lies, so each cut is off its target by half a document at most,
however many documents, or however large a group of equal texts, there are.

All on DataFrame functions. Defined cases. Null text: no bytes, size 1, checksum 0. Null id: first of its group. Rows that
repeat id and text are documents of their own; which of them is first does not show in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.work import stored

SHARDS = 16
LAW = "bytes"


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: the id, size (UTF-8 bytes and 1), text_crc32, law, shard, slot in the shard (gapless from 0)."""
    content = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("sum"),
        F.unhex(F.md5(content)).alias("digest"),
    )
    order = ("digest", "id")
    ranged = sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged)
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))  # a row for each partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = ranged.join(F.broadcast(starts), "part").select(
        "id",
        "size",
        "sum",
        "total",
        (F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("begin"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("row"),
    )
    twice = (2 * F.col("begin") + F.col("size")).cast("decimal(38,0)")  # of the document's middle
    placed = placed.withColumn("shard", F.least(F.floor(twice * shards / (2 * F.col("total"))).cast("int"), F.lit(shards - 1)))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_column),
        "size",
        F.col("sum").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
