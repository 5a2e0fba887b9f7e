"""Connected components of a graph held as a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import removed, written

MOST_ROUNDS = 60
#: Slices that a group is dealt in: a node with very many links, or a component with very many nodes, goes to that many tasks.
SLICES = 256


def with_least(rows: DataFrame, key: str, value: str, least: str) -> DataFrame:
    """``rows`` with the least ``value`` of their group. A group is dealt in slices, whose least values meet: at most ``SLICES`` rows for a group, and no more than it has."""
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(*rows.columns), F.lit(SLICES)))
    partial = sliced.groupBy(key, "slice").agg(F.min(value).alias("part"))
    whole = partial.groupBy(key).agg(F.min("part").alias(least))
    return sliced.join(partial.join(whole, key).select(key, "slice", least), [key, "slice"]).drop("slice")


def components(links: DataFrame) -> DataFrame:
    """``links``: columns a, b of one orderable type. Gives (node, component) for every node of a link.

    In a large-star round each node tells its larger neighbours its least neighbour; in a small-star
    round it tells its smaller ones. Both keep components whole and end in stars around the least
    node. The table of links never grows beyond the number of links, and each round is written to
    the shared folder, so that no lineage builds up and nothing is gathered on the driver.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = with_least(both, "u", "v", "m").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        # Each row is now (node, smaller node); the same nodes' least one is the centre of a small star.
        least = with_least(large, "u", "v", "m")
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        last, now = now, written(small.where("u <> v").distinct().select(F.col("u").alias("a"), F.col("v").alias("b")), "links")
        removed(last)
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
