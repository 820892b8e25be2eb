"""Connected components of a graph given by links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contractlake.llm.common import drop_staged, staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def with_group_min(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the least ``value`` of all rows with that long ``key``.

    The least is an aggregate with a partial result per task. The join back is on another
    spelling of the key, so that it has shuffles of its own, which adaptive execution can split:
    a key with a third of all rows is no group of one task.
    """
    spelt = F.bitwise_not(key).alias("_key")
    least = rows.groupBy(key).agg(F.min(value).alias(name))
    return rows.withColumn("_key", spelt).join(least.select(spelt, name), "_key").drop("_key")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (the least node that links reach) for each node that has links.

    ``links`` has two long columns ``u`` and ``v``; self-links, repeats and nulls don't matter.
    Each round turns the links of every node to the least node around it, first for neighbours
    above it, then for those below; links become stars around the least nodes in a number of
    rounds that grows with the logarithm of the longest path. Every round's links are written to
    the shared folder, which cuts the lineage. Whether they are stars is all the driver learns.
    """
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    made: list[str] = []
    now = staged(now.distinct(), "links", made)
    for _ in range(max_rounds):
        if _are_stars(now):
            stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            centres = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
            return stars.union(centres.distinct())
        around = with_group_min(_both_ways(now), "u", "v", "least").withColumn("least", F.least("u", "least"))
        large = around.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        below = with_group_min(large, "u", "v", "least")
        moved = below.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = moved.union(below.select("u", F.col("least").alias("v")))
        before, made = made, []
        now = staged(small.distinct(), "links", made)
        drop_staged(links.sparkSession, before)
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")


def _are_stars(links: DataFrame) -> bool:
    """Every node has one link down, or links up only."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down")).union(
        links.select(F.col("v").alias("node"), F.lit(0).alias("down"))
    )
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("n"))
    return sums.where("down > 1 OR (down = 1 AND n > 1)").isEmpty()
