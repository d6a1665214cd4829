"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.session import checkpointed


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each vertex links its (larger) neighbours to the smallest vertex next to it. ``edges``: (u, v) with u > v."""
    seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = seen.join(least, "u")
    if both_ways:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex of ``edges (a, b)``; root is the smallest vertex reachable.

    Every round ends in a written table. Vertices keep one link each when nothing changes any more, which a count and a
    hash sum over the table show; only these two numbers reach the driver.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    before = None
    while True:
        now = checkpointed(_stars(_stars(now, True), False))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return leaves.unionByName(now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())
