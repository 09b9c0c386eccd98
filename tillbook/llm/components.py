"""Connected components of a graph given as edges, by alternating stars.

Each round is two joins and grouped minima; no node's neighbours are ever gathered, and the number of
rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node with the least node that it is paired with, or itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of its component, for every node of the edges (a, b)."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        # Large star: every greater neighbour is joined to the least node of the neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the lesser neighbours and the node itself are joined to the least of them.
        linked = large.join(_lowest(large), "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
