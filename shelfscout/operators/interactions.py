"""Interaction universe, leave-one-out split and dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfscout.functions.scalars import pick_key
from shelfscout.operators.ordered import with_position
from shelfscout.session import spill


def positive_pairs(interactions: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Distinct (user, item) pairs with a positive vote."""
    return interactions.where("voted_up").select(user, item).distinct()


def interaction_universe(interactions: DataFrame, catalog: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Distinct positive pairs whose item is in the catalog."""
    return positive_pairs(interactions, user, item).join(catalog.select(item), item, "left_semi").select(user, item)


def qualifying_users(pairs: DataFrame, user: str = "user_id", minimum: int = 2) -> DataFrame:
    return pairs.groupBy(user).agg(F.count("*").alias("n_items")).where(F.col("n_items") >= minimum)


def hold_out(pairs: DataFrame, seed: int, user: str = "user_id", item: str = "item_id", minimum: int = 2) -> DataFrame:
    """One item of each qualifying user, the first by ``pick_key``: ``(user, item)``.

    The least key is an aggregate, so a user with many items is reduced before the shuffle. The result is
    written: Spark splits the partition of a hot user only in a join of two plain shuffles, which a join with
    an aggregate over the same key is not.
    """
    keyed = F.struct(pick_key(seed, user, item).alias("key"), F.col(item).alias("item"))
    picks = pairs.groupBy(user).agg(F.count("*").alias("_n"), F.min(keyed).alias("_pick"))
    return spill(picks.where(F.col("_n") >= minimum).select(user, F.col("_pick.item").alias(item)), "heldout")


def train_pairs(pairs: DataFrame, heldout: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """The other pairs of the users in ``heldout``; users without a held-out item are left out."""
    picked = heldout.select(user, F.col(item).alias("_held"))
    return pairs.join(picked, user).where(F.col(item) != F.col("_held")).select(user, item)


def user_histories(
    pairs: DataFrame, user: str = "user_id", item: str = "item_id", span: int = 1000
) -> DataFrame:
    """Sorted item lists, cut by id range: ``(user, chunk, n_items, items)``.

    A chunk covers ``span`` consecutive item ids, so no list grows with the activity of its user.
    """
    chunked = pairs.withColumn("chunk", F.floor(F.col(item).cast("long") / span))
    return chunked.groupBy(user, "chunk").agg(
        F.count("*").alias("n_items"), F.array_sort(F.collect_list(item)).alias("items")
    )


def dense_index(pairs: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """Sorted distinct ids with their 0-based place: ``(column, name)``."""
    return with_position(pairs.select(column).distinct(), [column], name)


def train_matrix(train: DataFrame, users: DataFrame, items: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Ones of the train matrix in dense coordinates: ``(row, column)``."""
    placed = train.join(users.select(user, F.col("idx").alias("row")), user)
    return placed.join(items.select(item, F.col("idx").alias("column")), item).select("row", "column")
