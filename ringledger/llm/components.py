"""Connected components of a graph of links, by the large-star and small-star method."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.storage import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (columns ``a``, ``b``).

    A component is named by its smallest node. Each round hangs nodes on the smallest
    neighbour they know, first those above a node and then those below, until nothing
    changes; rounds grow with the logarithm of the longest path. A node with very many
    links meets its minimum in a join, which adaptive execution can split.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.where("a <> b").distinct(), "edges")
    before, now = None, _state(edges)
    while before != now:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, now = now, _state(edges)
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    parts = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(parts)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    above = both.where("b > a").join(least, "a")
    return above.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    below = edges.join(least, "a").where("b <> least")
    moved = below.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
