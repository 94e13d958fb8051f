"""Hit rates, comparison of systems and worked examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfscout.functions.scalars import rounded

# The cut-offs and mixing weights that are reported.
CUTOFFS = [5, 10, 20]
ALPHAS = [0.1, 0.3, 0.5, 0.7, 0.9]
LATENT_SIZES = [10, 20, 50]


def hit_rates(ranks: DataFrame, cutoffs: Sequence[int] = tuple(CUTOFFS), by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """``(*by, k, hit_rate, n_tested)``: share of users whose held-out item ranks within k; 0 with no user."""
    wide = ranks.groupBy(*by).agg(
        F.count("*").alias("n_tested"),
        *[F.sum((F.col("rank") <= k).cast("long")).alias(str(k)) for k in cutoffs],
    )
    long = wide.unpivot([*by, "n_tested"], [str(k) for k in cutoffs], "k", "hits")
    rate = F.when(F.col("n_tested") > 0, F.col("hits") / F.col("n_tested")).otherwise(F.lit(0.0))
    return long.select(*by, F.col("k").cast("int").alias("k"), rounded(rate, digits).alias("hit_rate"), "n_tested")


def best_config(rates: DataFrame, config: str = "config", order: str = "position", k: int = 10) -> DataFrame:
    """The configuration with the highest hit rate at ``k``; the first in ``order`` on ties."""
    return rates.where(F.col("k") == k).orderBy(F.desc("hit_rate"), F.asc(order)).limit(1).select(config, "hit_rate")


def comparison(rates: DataFrame) -> DataFrame:
    """One row per system and configuration with a column per cut-off."""
    cells = [F.max(F.when(F.col("k") == k, F.col("hit_rate"))).alias(f"hr_{k}") for k in CUTOFFS]
    return rates.groupBy("system", "config").agg(*cells)


def series(rates: DataFrame) -> DataFrame:
    """Rates whose configurations read ``sweep=setting`` as ``(sweep, setting, k, hit_rate)``."""
    name = F.split("config", "=")
    return rates.select(name[0].alias("sweep"), name[1].cast("double").alias("setting"), "k", "hit_rate")


def headline(table: DataFrame) -> DataFrame:
    """The comparison with only the best hybrid kept; configurations are few, so the window is small."""
    order = Window.partitionBy("system").orderBy(F.desc("hr_10"), F.asc("config"))
    ranked = table.withColumn("_r", F.row_number().over(order))
    return ranked.where((F.col("system") != "hybrid") | (F.col("_r") == 1)).drop("_r")


def named(df: DataFrame, catalog: DataFrame, item: str = "item_id", name: str = "name", out: str = "item_name") -> DataFrame:
    """Add the item's name, or its id when the catalog has none."""
    names = catalog.select(item, F.col(name).alias("_name"))
    return df.join(names, item, "left").withColumn(out, F.coalesce("_name", F.col(item).cast("string"))).drop("_name")


def error_examples(
    ranks: DataFrame,
    train: DataFrame,
    recommended: DataFrame,
    catalog: DataFrame,
    k: int = 10,
    n_examples: int = 5,
    user: str = "user_id",
    item: str = "item_id",
) -> DataFrame:
    """First users by id with a hit and with a miss at ``k``: held-out name, three train names, top three names.

    At most ``2 * n_examples`` users are picked first; histories and names are looked up for those only.
    """
    judged = ranks.select(user, item, (F.col("rank") <= k).alias("hit"))
    picked = judged.where("hit").orderBy(user).limit(n_examples).unionByName(
        judged.where(~F.col("hit")).orderBy(user).limit(n_examples)
    )
    users = F.broadcast(picked.select(user))
    first = Window.partitionBy(user).orderBy(item)
    history = train.join(users, user).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= 3)
    top = recommended.join(users, user).where(F.col("rank") <= 3).select(user, item, F.col("rank").alias("_n"))

    def listed(rows: DataFrame, out: str) -> DataFrame:
        entry = F.struct("_n", "item_name")
        joined = named(rows, catalog, item).groupBy(user).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
        return joined.select(user, F.array_join(F.col("_e.item_name"), " | ").alias(out))

    held = named(picked, catalog, item, out="held_out")
    return (
        held.join(listed(history, "train_items"), user, "left")
        .join(listed(top, "top_3"), user, "left")
        .select(user, "hit", "held_out", "train_items", "top_3")
    )
