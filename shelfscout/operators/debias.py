"""Hit rates freed of popularity, and the prior that a user's segments give to items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfscout.functions.scalars import rounded
from shelfscout.functions.vectors import on_grid
from shelfscout.operators.evaluation import CUTOFFS
from shelfscout.session import spill

GAMMA = 0.5
FLOOR = 0.01


def propensities(train: DataFrame, gamma: float = GAMMA, floor: float = FLOOR, item: str = "item_id") -> DataFrame:
    """``(item, propensity)``: the item's train pairs over those of the most popular one, to the power ``gamma``, at least ``floor``."""
    counts = spill(train.groupBy(item).agg(F.count("*").alias("_n")), "item-counts")
    most = counts.agg(F.max("_n")).first()[0] or 1
    return counts.select(item, F.greatest(F.pow(F.col("_n") / most, F.lit(gamma)), F.lit(floor)).alias("propensity"))


def debiased_hit_rates(
    ranks: DataFrame, chances: DataFrame, floor: float = FLOOR, cutoffs: Sequence[int] = tuple(CUTOFFS), by: Sequence[str] = (),
    item: str = "item_id", digits: int = 6,
) -> DataFrame:
    """``(*by, k, hit_rate, n_tested)`` where a user weighs one over the propensity of the held-out item, self-normalised.

    A held-out item without a train pair has the propensity ``floor``; the rate is 0 with no user.
    """
    weighed = ranks.join(chances, item, "left").withColumn("_w", 1 / F.coalesce("propensity", F.lit(floor)))
    wide = weighed.groupBy(*by).agg(
        F.count("*").alias("n_tested"), F.sum("_w").alias("_all"),
        *[F.sum(F.when(F.col("rank") <= k, F.col("_w")).otherwise(0.0)).alias(str(k)) for k in cutoffs],
    )
    long = wide.unpivot([*by, "n_tested", "_all"], [str(k) for k in cutoffs], "k", "_hits")
    rate = F.when(F.col("n_tested") > 0, F.col("_hits") / F.col("_all")).otherwise(F.lit(0.0))
    return long.select(*by, F.col("k").cast("int").alias("k"), rounded(rate, digits).alias("hit_rate"), "n_tested")


def segment_affinity(
    train: DataFrame, segments: DataFrame, n_segments: int, user: str = "user_id", item: str = "item_id", segment: str = "cluster", out: str = "prior"
) -> DataFrame:
    """``(user, out)``: the share of the user's train items in each segment, on the grid of the scores.

    Counts per user and segment are made first, so a user's array has ``n_segments`` entries however long the history.
    """
    counts = train.join(segments.select(item, segment), item).groupBy(user).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(segment) == s).alias(f"_{s}") for s in range(n_segments)]
    )
    return counts.select(user, on_grid(F.array(*[F.col(f"_{s}") / F.col("_n") for s in range(n_segments)])).alias(out))


def segment_membership(items: DataFrame, segments: DataFrame, n_segments: int, item: str = "item_id", segment: str = "cluster", out: str = "prior") -> DataFrame:
    """``(item, out)``: one at the item's segment, zeros elsewhere and for an item without a segment."""
    place = F.coalesce(F.col(segment), F.lit(-1))
    return items.select(item).join(segments.select(item, segment), item, "left").select(
        item, F.array(*[(place == s).cast("double") for s in range(n_segments)]).alias(out)
    )
