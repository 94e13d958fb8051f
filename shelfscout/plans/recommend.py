"""Stage 4: four recommenders compared by leave-one-out hit rate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfscout.functions.tokens import content_blob
from shelfscout.operators import evaluation, factorization, interactions as inter, scoring
from shelfscout.operators.evaluation import ALPHAS, LATENT_SIZES
from shelfscout.plans.features import content_vectors
from shelfscout.plans.metrics import MetricLog
from shelfscout.session import configure, spill
from shelfscout.sources import store


@dataclass
class Recommendation:
    comparison: DataFrame  # (system, config, hr_5, hr_10, hr_20)
    losses: list[float]
    best_k: int
    examples: DataFrame
    top_n: DataFrame
    metrics: DataFrame
    written: list[str]


def evaluate_factors(
    model: factorization.FactorModel, items: DataFrame, train: DataFrame, heldout: DataFrame
) -> scoring.Scorer:
    """Scorer of a factor model. An item without a train pair keeps its initial factors."""
    start = factorization.initial_factors(items, model.item, "q", model.k, factorization.SEED)
    untouched = start.join(model.items, model.item, "left_anti")
    whole = factorization.FactorModel(model.users, model.items.unionByName(untouched), [], model.k, model.user, model.item)
    return scoring.prepare(whole.vectors("user"), whole.vectors("item"), train, heldout, ["mf"], model.user, model.item)


def factor_sweep(
    train: DataFrame, heldout: DataFrame, items: DataFrame, sizes: list[int] | None = None, epochs: int = factorization.EPOCHS
) -> tuple[DataFrame, dict[int, factorization.FactorModel], int]:
    """Hit rates of each latent size, the fitted models and the size with the best HR@10 (the first on ties)."""
    models, rates = {}, None
    for k in sizes or LATENT_SIZES:
        models[k] = factorization.fit_factors(train, k, epochs=epochs)
        ranks = scoring.heldout_ranks(evaluate_factors(models[k], items, train, heldout), [scoring.Blend(f"k={k}")])
        rate = evaluation.hit_rates(ranks, by=["config"]).withColumn("position", F.lit(k))
        rates = rate if rates is None else rates.unionByName(rate)
    rates = spill(rates, "mf-rates")
    best = evaluation.best_config(rates).first()["config"]
    return rates, models, int(best.split("=")[1])


def run_recommendation(
    spark: SparkSession,
    interactions: DataFrame,
    catalog: DataFrame,
    out_folder: str,
    blob: Column | None = None,
    popularity_column: str | None = "recommendations",
    seed: int = 42,
    sizes: list[int] | None = None,
    epochs: int = factorization.EPOCHS,
    max_features: int = 3000,
    components: int = 50,
    top_n: int = 10,
) -> Recommendation:
    """``interactions`` has user_id, item_id and voted_up; ``catalog`` item_id, name and the text columns.

    With ``popularity_column=None`` popularity is the number of interactions per item.
    """
    configure(spark)
    log = MetricLog("recommendation")
    pairs = spill(inter.interaction_universe(interactions, catalog), "pairs")
    heldout = inter.hold_out(pairs, seed)
    train = spill(inter.train_pairs(pairs, heldout), "train")
    items = spill(pairs.select("item_id").distinct(), "items")
    counts = pairs.agg(F.count_distinct("user_id").alias("n_users"), F.count("*").alias("n_positive")).first()
    n_items, n_train = items.count(), train.count()
    log.add("", "n_users", counts["n_users"])
    log.add("", "n_items", n_items)
    log.add("", "n_qualifying_users", heldout.count())
    log.add("", "density_positive", counts["n_positive"] / max(counts["n_users"] * n_items, 1))
    log.add("", "density_train", n_train / max(counts["n_users"] * n_items, 1))

    if popularity_column is None:
        votes = interactions.groupBy("item_id").agg(F.count("*").alias("n"))
        popular = scoring.popularity_scores(items, votes, column="n")
    else:
        popular = scoring.popularity_scores(items, catalog, column=popularity_column)
    popular_ranks = scoring.popularity_ranks(popular, train, heldout).withColumn("config", F.lit(""))

    vectors, width = content_vectors(
        catalog, items, blob if blob is not None else content_blob(), max_features=max_features, components=components
    )
    vectors = spill(vectors, "content-vectors")
    profiles = scoring.user_profiles(train, vectors, width)
    content_users, content_items = scoring.cosine_model(profiles, vectors, items, width=width)

    mf_rates, models, best_k = factor_sweep(train, heldout, items, sizes, epochs)
    best = models[best_k]
    start = factorization.initial_factors(items, "item_id", "q", best_k, factorization.SEED)
    all_items = best.items.unionByName(start.join(best.items, "item_id", "left_anti"))
    whole = factorization.FactorModel(best.users, all_items, best.losses, best_k, "user_id", "item_id")
    both = scoring.prepare(
        content_users.join(whole.vectors("user"), "user_id"),
        content_items.join(whole.vectors("item"), "item_id"),
        train,
        heldout,
        ["content", "mf"],
    )
    ends = scoring.score_extremes(both)
    blends = [scoring.Blend(f"alpha={a:g}", a, (*ends["content"], *ends["mf"])) for a in ALPHAS]
    ranks = spill(scoring.heldout_ranks(both, [scoring.Blend("content"), *blends]), "ranks")

    alone = F.col("config") == "content"
    scored = evaluation.hit_rates(ranks, by=["config"]).select(
        F.when(alone, "content").otherwise("hybrid").alias("system"),
        F.when(alone, "").otherwise(F.col("config")).alias("config"),
        "k",
        "hit_rate",
    )
    rates = (
        evaluation.hit_rates(popular_ranks, by=["config"])
        .select(F.lit("popularity").alias("system"), "config", "k", "hit_rate")
        .unionByName(scored)
        .unionByName(mf_rates.select(F.lit("mf").alias("system"), "config", "k", "hit_rate"))
    )
    rates = spill(rates, "rates")
    comparison = evaluation.comparison(rates)

    mf_scorer = evaluate_factors(best, items, train, heldout)
    mf_ranks = scoring.heldout_ranks(mf_scorer, [scoring.Blend("mf")])
    mf_top = spill(scoring.top_k(mf_scorer, top_n), "top")
    examples = evaluation.error_examples(mf_ranks, train, mf_top, catalog)

    best_alpha = evaluation.best_config(
        rates.where("system = 'hybrid'").withColumn("position", F.regexp_extract("config", r"([\d.]+)", 1).cast("double"))
    ).first()
    blend = next(b for b in blends if best_alpha is None or b.name == best_alpha["config"])
    listed = evaluation.named(scoring.top_k(both, top_n, blend), catalog)

    for row in rates.collect():
        log.add(f"{row['system']}:{row['config']}", f"hr_{row['k']}", row["hit_rate"])
    log.add("mf", "best_k", best_k)
    for epoch, loss in enumerate(best.losses, 1):
        log.add("mf_loss", str(epoch), loss)
    log.add("mf_loss", "relative_decrease", factorization.relative_decrease(best.losses))
    metrics = log.table(spark)
    written = [
        store.write_table(best.vectors("user"), f"{out_folder}/mf_user_factors"),
        store.write_table(whole.vectors("item"), f"{out_folder}/mf_item_factors"),
        store.write_table(vectors, f"{out_folder}/content_vectors"),
        store.write_table(listed, f"{out_folder}/top_n", cluster_by="user_id"),
        store.write_table(examples, f"{out_folder}/error_examples"),
        store.write_metrics(metrics, f"{out_folder}/metrics"),
    ]
    return Recommendation(comparison, best.losses, best_k, examples, spark.read.parquet(f"{out_folder}/top_n"), metrics, written)
