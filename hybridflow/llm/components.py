"""Connected components by alternating large-star and small-star over a table of links.

Each step is a minimum per node and a join of the links with it. The minimum combines in the reading
task and the join is one Spark may split, so a node that a third of all links meet stays spread out.
Links are written between rounds and the round before is removed. The loop ends when a round changes
nothing, which a count and two sums of fingerprints tell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest of the node's neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")).withColumnRenamed("a", "node")
    moved = both.join(least, both["a"] == least["node"]).where("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    moved = links.join(least, links["a"] == least["node"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()


def _print_of(links: DataFrame):
    return links.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
    ).first()


def components(links: DataFrame, cuts: Cuts) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with a link to another.

    ``links`` has columns ``a, b`` (long) in any direction; repeated links and links of a node with
    itself are allowed. Nodes that have no link don't come back.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = cuts.cut(links.where("a <> b").select(larger, smaller).distinct())
    seen = _print_of(now)
    while True:
        after = cuts.cut(_small_star(_large_star(now)))
        found = _print_of(after)
        cuts.drop(now)
        now = after
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
