"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vocatio.llm.tables import stored


def _are_stars(links: DataFrame) -> bool:
    """No node has two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return not sums.filter("up > 1 OR (up > 0 AND down > 0)").take(1)


def star_components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the links (u, v): the smallest node reachable.

    Large-star and small-star steps in turn until the links are stars. Every step is a partial
    minimum per node and a join back, so a node with many links is no group in memory. Loops
    and repeated links do no harm; no links give no rows.
    """
    links = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    while not _are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: each larger neighbour moves to the least of the neighbourhood.
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.filter("u <> v").distinct()
        # Small star: a node and its smaller neighbours move to the least of them.
        lowest = moved.groupBy("u").agg(F.min("v").alias("m"))
        closer = moved.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        closer = closer.unionByName(lowest.select("u", F.col("m").alias("v")))
        links = stored(closer.filter("u <> v").distinct(), "links")
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
