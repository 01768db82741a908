"""Connected components by alternating star steps, with a written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours point to the least of its neighbourhood; small star: the others."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    around = pairs.unionByName(turned) if large else turned
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    met = around.where("v > u") if large else around
    linked = met.join(least, met["u"] == least["w"])
    moved = linked.select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("w").alias("b")))
    return moved.where("a < b").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node reachable from it.

    Edges always point from the greater to the smaller node. Both steps keep components and shorten paths, so the
    rounds grow with the logarithm of the longest path. Nodes without link are not returned; no links give no rows.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    edges, before = stage(edges, "links"), None
    while (now := _state(edges)) != before and now[0]:
        edges, before = stage(_star(_star(edges, True), False), "stars"), now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Count and an order-free digest of the edges: equal when a round changed nothing."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
