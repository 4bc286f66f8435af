"""Connected components of a graph whose edges stay in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebind.sources.staging import staged


def _smallest(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with m: the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not its component's least.

    Alternates two steps until nothing changes: each node hands its larger neighbours over to
    its least neighbour, then its smaller ones. The graph becomes stars after a number of rounds
    that grows with the logarithm of the longest path. Each round is a written table, so a lost
    executor costs one round; no neighbour list is ever gathered, so a hub is rows like others.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                              F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        # every node's smaller neighbours, and itself, go to the least of them
        small = _smallest(large)
        small = small.select("v", "m").union(small.select(F.col("u").alias("v"), "m"))
        now = staged(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                       F.count_distinct("u")).first()
        if seen == mark and (seen[0] == seen[2]):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
