"""Connected components of a set of links, by alternating stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countypanel.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of every node in links, which has bigint columns a and b.

    A round hangs every larger neighbour of a node on the node's smallest neighbour, then every smaller one
    likewise. Rounds grow with the logarithm of the longest chain. Each round's links are written to the shared
    folder, which cuts the lineage; a node with many links is reduced on the map side.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        edges = _star(edges, both=True)
        edges = stored(_star(edges, both=False), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Larger (both) or smaller neighbours, and the node itself, linked to the smallest neighbour. u > v in and out."""
    near = edges.select("u", "v")
    if both:
        near = near.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if both:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
