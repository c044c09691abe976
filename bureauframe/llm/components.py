"""Connected components of an edge table by alternating large-star and small-star steps.

Every round is a few joins and aggregations over the edges. Minima are combined before the shuffle
and written before they are joined, so adaptive execution can split the rows of a hub over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import durable


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each `u`, or `u` itself."""
    return durable(
        edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.filter("v > u").join(_least(both), "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of the edges (u, v) but the
    smallest ones themselves. No edges, no rows."""
    edges = durable(edges.filter("u != v").select("u", "v").distinct())
    before = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(found) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = tuple(found)
        wide = durable(_large_star(edges).filter("u != v").distinct())
        edges = durable(_small_star(wide).filter("u != v").distinct())
