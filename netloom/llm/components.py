"""Connected components of links, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netloom.session import Stages


def _smallest_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges`` (distinct u, v; v < u) has one edge to a smaller node, which has none."""
    ends = edges.select("u", F.lit(1).alias("down")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("down")))
    nodes = ends.groupBy("u").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("least") == 0)))).first()[0] == 0


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the smallest node reachable.

    Alternates the large-star and small-star steps: every node hands its larger (then its smaller) neighbours to the smallest
    one, until each node points at its root. Only partial minima and joins on one node are used, so a hub is never
    gathered. All state is in stored tables, two a turn; a turn that leaves stars is the last.
    """
    edges = stages.store("edges0", links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    turn = 0
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_smallest_neighbour(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stages.store("large", large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        turn += 1
        edges = stages.store(f"edges{turn}", small.where("u <> v").distinct())
        stages.drop(f"edges{turn - 1}")
    stages.drop("large")
    # Every node now has one edge, to its root; roots have none of their own.
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
