"""Connected components of a table of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.plans.staging import stage


def _contract(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (``_u`` > ``_v``); minima are pre-aggregated per node."""
    both = edges.unionByName(edges.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
    least = both.groupBy("_u").agg(F.min("_v").alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))
    large = both.join(least, "_u").where("_v > _u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
    large = large.where("_u > _v").distinct()
    least = large.groupBy("_u").agg(F.min("_v").alias("_m"))
    small = large.join(least, "_u").select(F.explode(F.array("_u", "_v")).alias("_u"), F.col("_m").alias("_v"))
    return small.where("_u > _v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node that has a link to another.

    Rounds are logarithmic in the longest path; each is staged in the shared folder, and only a count and a checksum
    come to the driver.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v")).distinct()
    edges, before = stage(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stage(_contract(edges), "links")
    stars = edges.select(F.col("_u").alias("node"), F.col("_v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
