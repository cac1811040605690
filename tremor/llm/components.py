"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.session import cut_lineage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v: each node's larger (smaller) neighbours move to the least one it knows."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); component is the least node reachable.

    Each round is a few shuffles of the remaining edges, cut by a checkpoint; the
    edges end as stars about the least nodes.  Only one row per round comes to the driver.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, seen = cut_lineage(e), None
    while True:
        now = tuple(e.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())
        if now == seen or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen, e = now, cut_lineage(_stars(_stars(e, True), False))
