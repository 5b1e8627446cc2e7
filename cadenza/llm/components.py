"""Connected components of a large graph: alternating large-star and small-star rounds.

The method is the published one of Kiveris and others (2014). Each round hangs the neighbours
of a node on the smallest of them, so the rounds needed grow with the logarithm of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import settle


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): every node with a link, and the smallest node that it reaches.

    Self links, repeated links and nulls are left out. No links give no rows. All nodes
    stay in tables: nothing is collected but a count and a checksum for each round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges, before = settle(edges, "links"), None
    while (now := _checksum(edges)) != before:
        before = now
        edges = settle(_small_star(_large_star(edges)), "links")
    parts = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return parts.unionByName(parts.select(F.col("component").alias("node"), "component").distinct())


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), mixed).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
