"""Joins and aggregates over the review table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscout.operators.ordered import weighted_quantiles
from shelfscout.session import spill


def enrich(reviews: DataFrame, catalog: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Inner join of the fact rows with a few catalog columns.

    Unhinted: the planner broadcasts the catalog while its measured size is small, and otherwise sorts and
    splits the partitions of hot items.
    """
    return reviews.join(catalog.select(key, *columns), key)


def item_aggregates(reviews: DataFrame, key: str, vote: str = "voted_up", playtime: str = "playtime") -> DataFrame:
    """Per item: number of reviews, vote rate, mean and exact median playtime.

    Reviews are first counted per (item, playtime), so a hot item leaves its distinct playtimes only, spread
    over all tasks; every figure is then taken from that table.
    """
    rate = F.col(vote).cast("int")
    counts = spill(
        reviews.groupBy(key, F.col(playtime).cast("double").alias("_t")).agg(
            F.count("*").alias("_n"), F.count(rate).alias("_votes"), F.sum(rate).alias("_up")
        ),
        "item-playtimes",
    )
    timed = F.when(F.col("_t").isNotNull(), F.col("_n"))
    figures = counts.groupBy(key).agg(
        F.sum("_n").alias("reviews_count"),
        (F.sum("_up") / F.sum("_votes")).alias("voted_up_rate"),
        (F.sum(F.col("_t") * timed) / F.sum(timed)).alias("playtime_mean"),
    )
    medians = weighted_quantiles(counts, [key], "_t", "_n", [0.5]).select(key, F.col("quantile").alias("playtime_median"))
    return figures.join(medians, key, "left")


def with_item_aggregates(catalog: DataFrame, aggregates: DataFrame, key: str) -> DataFrame:
    return catalog.join(aggregates, key, "left")


def coverage(joined: DataFrame, column: str = "reviews_count") -> DataFrame:
    """Share of catalog rows that have reviews."""
    return joined.agg(F.avg(F.col(column).isNotNull().cast("int")).alias("coverage"))


def universe_counts(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(user).alias("n_users"),
        F.count_distinct(item).alias("n_items"),
    )


def label_counts(df: DataFrame, label: str, n: int | None = None) -> DataFrame:
    """Rows per label, the most frequent first."""
    counts = df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(label))
    return counts if n is None else counts.limit(n)


def top_names(reviews: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` names with most rows; equal counts by name."""
    sizes = reviews.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return sizes.orderBy(F.desc("n"), F.asc(name)).limit(n)


def vote_rate_of_top(reviews: DataFrame, name: str, vote: str, n: int) -> DataFrame:
    """Percentage of positive votes of the top names. At most ``n`` names are left after the aggregate."""
    stats = (
        reviews.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("*").alias("n"), (F.avg(F.col(vote).cast("int")) * 100).alias("rate"))
    )
    return stats.orderBy(F.desc("n"), F.asc(name)).limit(n).orderBy(F.asc("rate"), F.asc(name)).select(name, "rate")


def token_counts(df: DataFrame, tokens, name: str = "token") -> DataFrame:
    """Occurrences of each token of an array expression over all rows."""
    exploded = df.select(F.explode(tokens).alias(name))
    return exploded.where(F.col(name) != "").groupBy(name).agg(F.count("*").alias("n"))
