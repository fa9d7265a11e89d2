"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is an aggregate and a join over edges, so a node with very many neighbours is split
like any skewed join key, and nothing is gathered on the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tidemill.session import stored



def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, get linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (longs); the root is the smallest node.

    Self-links are ignored, so a node that has no other link is not listed.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
