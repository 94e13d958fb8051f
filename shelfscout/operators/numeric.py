"""Numeric feature block: coerce, drop infinities, impute, winsorize, standardize."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.functions.scalars import age_days, clean_number, clip, flag, release_date, release_parts
from shelfscout.operators.ordered import stacked, value_counts, weighted_quantiles
from shelfscout.sources.schema import DATE_COLUMNS, NUMERIC_COLUMNS, PLATFORM_COLUMNS, REVIEW_COLUMNS


def numeric_column_set(with_dates: bool = True, with_reviews: bool = False) -> list[str]:
    return (
        NUMERIC_COLUMNS
        + PLATFORM_COLUMNS
        + (DATE_COLUMNS if with_dates else [])
        + (REVIEW_COLUMNS if with_reviews else [])
    )


def typed_catalog(catalog: DataFrame, as_of: str) -> DataFrame:
    """Platform flags to 0/1 and the release date to year, month and age."""
    typed = catalog.withColumn("release_date", release_date("release_date"))
    return typed.withColumns(
        {
            **{c: flag(c) for c in PLATFORM_COLUMNS},
            **release_parts("release_date"),
            "release_age_days": age_days("release_date", as_of),
        }
    )


def coerced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_number(c) for c in columns})


@dataclass(frozen=True)
class ColumnStats:
    """What one numeric column needs to be cleaned and scaled; one row per column, so it is kept on the driver."""

    median: float
    low: float
    high: float
    mean: float
    std: float


def fit_columns(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> dict[str, ColumnStats]:
    """Statistics of all columns from one pass over ``df``.

    The pass leaves the distinct values of each column with their counts; the median, the bounds of the
    imputed column and the moments of the clipped column are all taken from that smaller table.
    """
    counts = value_counts(stacked(coerced(df, columns), columns), ["column"], "value")
    medians = dict.fromkeys(columns, 0.0)
    for row in weighted_quantiles(counts, ["column"], "value", "weight", [0.5]).collect():
        medians[row["column"]] = row["quantile"]

    filled = counts.select("column", F.coalesce("value", _per_column(medians)).alias("value"), "weight")
    bounds: dict[str, list[float]] = {c: [] for c in columns}
    for row in weighted_quantiles(filled, ["column"], "value", "weight", [low, high]).collect():
        bounds[row["column"]].append(row["quantile"])
    lows = {c: min(b, default=0.0) for c, b in bounds.items()}
    highs = {c: max(b, default=0.0) for c, b in bounds.items()}

    # Deviations are taken from the median, which keeps the squares small.
    off = clip("value", _per_column(lows), _per_column(highs)) - _per_column(medians)
    moments = filled.select("column", "weight", off.alias("x")).groupBy("column").agg(
        (F.sum(F.col("x") * F.col("weight")) / F.sum("weight")).alias("m"),
        (F.sum(F.col("x") * F.col("x") * F.col("weight")) / F.sum("weight")).alias("s"),
    )
    stats = {}
    for row in moments.collect():
        c = row["column"]
        spread = max(row["s"] - row["m"] ** 2, 0.0) ** 0.5
        stats[c] = ColumnStats(medians[c], lows[c], highs[c], medians[c] + row["m"], spread)
    return stats


def _per_column(values: dict[str, float]) -> Column:
    """The value that belongs to the row's ``column``; one entry per column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("column")]


def imputed(c: str, stats: ColumnStats) -> Column:
    return F.coalesce(F.col(c), F.lit(stats.median))


def winsorized(c: str, stats: ColumnStats) -> Column:
    return clip(imputed(c, stats), stats.low, stats.high)


def standardized(c: str, stats: ColumnStats) -> Column:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    scale = stats.std if stats.std > 1e-12 * max(1.0, abs(stats.mean)) else 1.0
    return (winsorized(c, stats) - F.lit(stats.mean)) / F.lit(scale)


def numeric_block(df: DataFrame, key: str, columns: Sequence[str], stats: dict[str, ColumnStats] | None = None) -> DataFrame:
    """``(key, *columns)`` cleaned and standardized by one projection over the input."""
    stats = stats or fit_columns(df, columns)
    return coerced(df.select(key, *columns), columns).select(
        key, *[standardized(c, stats[c]).alias(c) for c in columns]
    )


def constant_columns(stats: dict[str, ColumnStats]) -> list[str]:
    return sorted(c for c, s in stats.items() if s.high == s.low)


def as_array(block: DataFrame, key: str, columns: Sequence[str], name: str = "vec") -> DataFrame:
    return block.select(key, F.array(*columns).alias(name))


def capped_histogram(df: DataFrame, column: str, bins: int = 60, cap: float | None = 0.99) -> DataFrame:
    """Equal-width histogram of a column capped at a quantile: ``(bin, low, high, n)``; the last bin is closed.

    A column without any value has no bins.
    """
    counts = value_counts(
        df.select(clean_number(column).alias("value")).where(F.col("value").isNotNull()), [], "value"
    )
    if counts.isEmpty():
        return counts.selectExpr("cast(null as int) AS bin", "value AS low", "value AS high", "weight AS n")
    if cap is not None:
        limit = weighted_quantiles(counts, [], "value", "weight", [cap]).first()["quantile"]
        counts = counts.withColumn("value", clip("value", None, limit))
    edge = counts.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
    low, width = edge["low"], (edge["high"] - edge["low"]) / bins
    place = F.floor((F.col("value") - low) / width) if width > 0 else F.lit(0)
    return (
        counts.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.sum("weight").alias("n"))
        .select("bin", (F.lit(low) + F.col("bin") * width).alias("low"), (F.lit(low) + (F.col("bin") + 1) * width).alias("high"), "n")
    )
