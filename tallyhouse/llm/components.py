"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


# A node with very many neighbours is a skewed join key. Adaptive execution splits those of a
# join of two plain shuffles, but not where one side is an aggregate over its own shuffle: so
# the least neighbours are stored before the links meet them.


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = stored(least.withColumn("m", F.least("a", "m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node it reaches.

    Alternates large and small stars until the links no longer change, which takes a
    number of rounds that grows with the logarithm of the nodes. Each round's links are
    written to the shared folder. Links to the node itself and repeated links are allowed;
    an empty table gives an empty one.
    """
    links = stored(edges.select("a", "b").where("a != b").distinct(), "links")
    before = None
    while (now := _signature(links)) != before:
        before = now
        if not now[0]:
            break
        stars = stored(_large_star(links).where("a != b").distinct(), "stars")
        links = stored(_small_star(stars).where("a != b").distinct(), "links")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
