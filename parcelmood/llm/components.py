"""Connected components of a graph given as edges between 64-bit node ids, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import stored


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, root): every node with an edge and the smallest node that it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every edge moves to the smallest neighbour,
    with a number of steps that grows with the logarithm of the longest path. Each step is a grouped minimum, which
    is combined before its shuffle, and a join whose hot nodes Spark may split. Self-loops and repeats are dropped.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges"
    )
    mark = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))
        )
        current = stored(moved.filter("u != v").distinct(), "edges")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = current.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()).groupBy(
        "node"
    ).agg(F.min("root").alias("root"))
