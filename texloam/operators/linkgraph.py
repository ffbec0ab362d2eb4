"""Walks over a stored link graph: breadth-first reach, and a queue with priorities and a budget."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from texloam.session import ensure_checkpoint_dir

SALTS = 64


def link_reach(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """(seed, node, depth): nodes reachable from each seed, each node once.

    ``edges`` has (src, dst), ``seeds`` has (seed, node).  The walk ends when a
    level finds nothing new, or at ``max_depth`` if given.  ``max_pages`` bounds
    the nodes per seed: nearer first, then by name; nodes past the bound are not
    followed.  Every level is one join and one anti-join and is checkpointed to
    the shared folder, which cuts the lineage and survives lost executors.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("src", "dst").distinct().repartition("src").checkpoint()
    level = seeds.select("seed", "node").distinct().withColumn("depth", F.lit(0))
    level = _bounded(level, None, max_pages).checkpoint()
    reached = level
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        found = (
            level.join(edges, level["node"] == edges["src"])
            .select("seed", F.col("dst").alias("node"))
            .distinct()
            .join(reached.select("seed", "node"), ["seed", "node"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        level = _bounded(found, reached, max_pages).checkpoint()
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    return reached


def _bounded(level: DataFrame, reached: DataFrame | None, max_pages: int | None) -> DataFrame:
    """The first nodes of a level that still fit the bound of their seed."""
    if max_pages is None:
        return level
    # Every seed is cut to the bound inside small salted groups first, so a seed
    # that reaches most of the graph is never ranked as a whole by one task.
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    inner = F.row_number().over(W.partitionBy("seed", "_salt").orderBy("node"))
    outer = F.row_number().over(W.partitionBy("seed").orderBy("node"))
    ranked = (
        level.withColumn("_salt", salt)
        .withColumn("_n", inner)
        .filter(F.col("_n") <= max_pages)
        .drop("_salt", "_n")
        .withColumn("_n", outer)
        .filter(F.col("_n") <= max_pages)
    )
    if reached is None:
        return ranked.drop("_n")
    used = reached.groupBy("seed").agg(F.count(F.lit(1)).alias("_used"))
    fits = F.col("_n") + F.col("_used") <= max_pages
    return ranked.join(used, "seed").filter(fits).drop("_n", "_used")


def priority_walk(edges: DataFrame, seeds: DataFrame, max_pages: int) -> DataFrame:
    """(seed, node, depth, visit): the first ``max_pages`` pages a queue would visit from each seed.

    ``edges`` has (src, dst, priority), ``seeds`` has (seed, node).  Every seed
    has a queue of its own.  A visited page appends its links, best priority
    first and then by name, unless the queue held them before; ``visit`` counts
    from 0.  Repeated edges count with their best priority, a null one is the
    least; edges without an end and seeds without a node are none.

    A queue visits level after level, so each level is one join: a page's place
    is that of the first page that links to it, then the link's own.  Of a page's
    links no more than twice the budget can matter, since the budget's pages at
    most are known already and as many others fill it; the rest are dropped by a
    rank limit that runs before the shuffle, so a hub is never gathered as a
    whole.  Levels are checkpointed to the shared folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    worth = (-F.coalesce(F.max("priority").cast("long"), F.lit(-(2**31)).cast("long"))).alias("worth")
    links = edges.dropna(subset=["src", "dst"]).groupBy("src", "dst").agg(worth)
    nth = F.row_number().over(W.partitionBy("src").orderBy("worth", "dst"))
    links = links.withColumn("_n", nth).filter(F.col("_n") <= 2 * max_pages).drop("_n").checkpoint()

    def numbered(level: DataFrame, order: list[str]) -> DataFrame:
        """The level's places in the queue, up to the budget."""
        visit = F.row_number().over(W.partitionBy("seed").orderBy(*order))
        return level.withColumn("visit", visit).filter(F.col("visit") <= max_pages)

    level = seeds.select("seed", "node").dropna(subset=["node"]).distinct()
    level = numbered(level, ["node"]).select("seed", "node", F.lit(0).alias("depth"), (F.col("visit") - 1).alias("visit"))
    reached = level = level.checkpoint()
    for depth in count(1):
        known = reached.select(F.col("seed").alias("_seed"), F.col("node").alias("_node"))
        same = F.col("seed").eqNullSafe(F.col("_seed")) & (F.col("node") == F.col("_node"))
        place = F.min(F.struct("visit", "worth")).alias("place")
        found = level.join(links, level["node"] == links["src"]).select("seed", F.col("dst").alias("node"), "visit", "worth")
        found = found.groupBy("seed", "node").agg(place).join(known, same, "left_anti")
        used = reached.groupBy(F.col("seed").alias("_seed")).agg(F.count(F.lit(1)).alias("_used"))
        found = numbered(found, ["place", "node"]).join(used, F.col("seed").eqNullSafe(F.col("_seed")))
        number = F.col("_used") + F.col("visit") - 1
        level = found.select("seed", "node", F.lit(depth).alias("depth"), number.cast("int").alias("visit"))
        level = level.filter(F.col("visit") < max_pages).checkpoint()
        if level.isEmpty():
            return reached
        reached = reached.unionByName(level)
