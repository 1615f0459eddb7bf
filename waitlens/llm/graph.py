"""Connected components of a graph of links, by alternating large and small stars.

Every round is two joins with the smallest neighbour of each node; no neighbour list is gathered anywhere, and a node with
very many links is a skewed join that Spark splits. Each round is written to the work folder. Rounds grow with the
logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.work import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least.hint("shuffle_merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Of each node a, with links to smaller nodes b: all of them, and a, to the least."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least.hint("shuffle_merge"), "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that links reach, for each node with a link to another.

    links: two columns of longs; order, repeats, loops and nulls do not matter (nulls and loops link nothing).
    """
    one, two = links.columns[:2]
    ends = (F.greatest(one, two).alias("a"), F.least(one, two).alias("b"))
    links = stored(links.dropna(subset=[one, two]).where(F.col(one) != F.col(two)).select(*ends).distinct())
    seen = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select("b", F.col("b").alias("c")).distinct()
            )
        seen = now
        links = stored(_small_star(_large_star(links)).distinct())
