"""Connected components by alternating star contractions; every step is a join or an aggregate over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscout.session import spill


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges`` (two long columns); root is the smallest node reachable.

    An edge set is kept as (v, u) with v > u. A round hangs the larger neighbours of each node, then the smaller
    ones, on the smallest node beside it, until nothing changes: about log² of the longest path in rounds. The joins
    meet two written tables, so Spark splits the partition of a node that half of all edges touch.
    """
    a, b = (F.col(c) for c in edges.columns)
    held = spill(
        edges.where(a != b).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct(), "edges"
    )
    seen = _signature(held)
    while True:
        both = held.select(F.col("v").alias("x"), F.col("u").alias("y")).unionAll(held.select(F.col("u"), F.col("v")))
        least = spill(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "least")
        large = spill(
            both.where(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct(), "large"
        )
        lower = spill(large.groupBy("v").agg(F.min("u").alias("m")), "lower")
        hung = large.join(lower, "v").where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
        held = spill(hung.unionAll(lower.select("v", F.col("m").alias("u"))).distinct(), "edges")
        now = _signature(held)
        if now == seen:
            return held.select(F.col("v").alias("node"), F.col("u").alias("root"))
        seen = now
