"""Popularity bins and exact-size samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.functions.scalars import pick_key
from shelfscout.operators.ordered import value_counts, weighted_quantiles, with_group_position
from shelfscout.session import spill

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def bin_edges(df: DataFrame, column: str, probabilities: list[float] | None = None) -> list[float]:
    """Distinct quantile edges, at most one per probability."""
    counts = value_counts(df.select(F.col(column).cast("double").alias("value")), [], "value")
    rows = weighted_quantiles(counts, [], "value", "weight", probabilities or QUARTILES).collect()
    return sorted({r["quantile"] for r in rows})


def quantile_bin(column: Column | str, edges: list[float]) -> Column:
    """Right-closed bins with the lowest edge included: the number of inner edges below the value."""
    x = F.col(column) if isinstance(column, str) else column
    below = F.lit(0)
    for edge in edges[1:-1]:
        below = below + (x > F.lit(edge)).cast("int")
    return F.when(x.isNotNull(), below)


def with_popularity_bin(df: DataFrame, column: str, name: str = "popularity_bin") -> DataFrame:
    return df.withColumn(name, quantile_bin(column, bin_edges(df, column)))


def stratified_sample(df: DataFrame, stratum: str, key: str, fraction: float, seed: int) -> DataFrame:
    """Exactly round-half-even(fraction * n) rows of each stratum, the first by ``pick_key``."""
    take = F.bround(F.count("*") * F.lit(fraction), 0).cast("long")
    sizes = spill(df.groupBy(stratum).agg(take.alias("_take")), "strata")
    keyed = df.withColumn("_pick", pick_key(seed, key))
    placed = with_group_position(keyed, [stratum], ["_pick", key], "_place")
    return placed.join(sizes, stratum).where(F.col("_place") < F.col("_take")).select(*df.columns)


def simple_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    return stratified_sample(df.withColumn("_one", F.lit(0)), "_one", key, fraction, seed).select(*df.columns)


def popularity_sample(df: DataFrame, column: str, key: str, fraction: float, seed: int) -> DataFrame:
    """Sample within popularity quartiles; plain when the counts have fewer than four distinct values."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    if df.select(column).distinct().limit(4).count() < 4:
        return simple_sample(df, key, fraction, seed)
    binned = with_popularity_bin(df, column, "_bin")
    return stratified_sample(binned, "_bin", key, fraction, seed).select(*df.columns)


def fixed_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows in ``pick_key`` order."""
    return df.orderBy(pick_key(seed, key), F.col(key)).limit(size)
