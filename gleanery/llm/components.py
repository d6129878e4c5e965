"""Connected components of a graph of any size by alternating stars.

Every round points the neighbours of a node to the smallest one (large star: those above the node, small star:
those below), as joins and aggregates over the edges; a node with many neighbours is a skewed join key, which
adaptive execution splits. The number of rounds grows with the logarithm of the longest path at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.stage import written


def _pointed(edges: DataFrame) -> DataFrame:
    """u, v -> (v, smallest of u and all v of u)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(low, "u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    above = _pointed(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return above.where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _pointed(down)
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the links (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    mark = None
    while True:
        edges = written(small_star(large_star(edges)))
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen["n"], seen["x"]) == mark:
            break
        mark = (seen["n"], seen["x"])
    parents = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return parents.union(roots)
