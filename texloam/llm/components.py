"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from texloam.llm.common import durable


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    several = edges.groupBy("hi").count().filter("count > 1")
    chained = edges.join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi")
    return several.isEmpty() and chained.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (hi, lo with hi > lo): root is the least node reachable.

    Each round hangs neighbours onto the least of them, first those above a
    node, then those below, and writes the edges.  The number of rounds grows
    with the logarithm of a component's length.  No adjacency list is ever
    gathered; the minima are partial aggregates.  It ends when all edges form
    stars, which the driver asks once a round.
    """
    edges = durable(edges.select("hi", "lo").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m"))
        least = least.select(F.col("hi").alias("node"), F.least("hi", "m").alias("m"))
        # Large star: every neighbour above a node moves to the node's least.
        large = (
            edges.join(least, edges["lo"] == least["node"])
            .select("hi", F.col("m").alias("lo"))
            .filter("hi > lo")
            .distinct()
        )
        large = durable(large)
        # Small star: a node and its neighbours below move to the least of these.
        floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(floor.withColumnRenamed("hi", "node"), F.col("hi") == F.col("node"))
        small = met.select(
            F.explode(
                F.array(
                    F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                    F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                )
            ).alias("e")
        ).select("e.*")
        edges = durable(small.filter("hi > lo").distinct())
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
