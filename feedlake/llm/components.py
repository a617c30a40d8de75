"""Connected components by alternating large-star and small-star steps, every step a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.store import settle


def _stars(neighbours: DataFrame) -> DataFrame:
    """``u, v, low``: each neighbour pair with the least of ``u`` and all its neighbours."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("low"))
    return neighbours.join(least.withColumn("low", F.least("low", "u")), "u")


def _normal(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller end."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; ``component`` is the least node that can be reached.

    ``edges`` has two integer columns ``u, v`` in any order; loops and repeated edges
    don't matter. No step gathers a node's neighbours, so a hub is no burden. The steps
    needed grow with the logarithm of the longest path.
    """
    edges = settle(_normal(edges), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = settle(_normal(large), "large-star")
        small = _stars(large)
        small = small.select("v", "low").unionByName(small.select(F.col("u").alias("v"), "low"))
        after = settle(_normal(small.select(F.col("v").alias("u"), F.col("low").alias("v"))), "small-star")
        # Both steps keep the components, so an unchanged set of edges is a set of stars around each least node.
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            break
        edges = after
    tops = after.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
