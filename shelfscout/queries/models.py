"""Fitted models: components, segments and factors. Checked by invariants, as SQL cannot follow a fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S
from shelfscout.functions.tokens import content_blob, segment_labels
from shelfscout.functions.vectors import unit
from shelfscout.operators import clustering, evaluation, factorization, labels, numeric, reduction, reviews, scoring, text
from shelfscout.operators.clustering import KMeansSpec
from shelfscout.plans import features as feature_plan, recommend as recommend_plan, segments as segment_plan
from shelfscout.queries.ranking import split
from shelfscout.queries.registry import SPLIT, query, r6
from shelfscout.session import spill
from shelfscout.sources import tables

NUMERIC = ["price", "size", "reviews_count", "voted_up_rate", "playtime_mean", "playtime_median"]


def item_numbers(spark, folder):
    """Numeric block of the catalog with its review aggregates: ``(block, vote rates)``."""
    stats = reviews.item_aggregates(tables.interactions(spark, folder), "item_id")
    joined = spill(reviews.with_item_aggregates(tables.catalog(spark, folder), stats, "item_id"), "catalog")
    block = numeric.as_array(numeric.numeric_block(joined, "item_id", NUMERIC), "item_id", NUMERIC)
    return spill(block, "numeric"), joined


@query("pca_transform")
def pca_transform(spark, folder):
    block, _ = item_numbers(spark, folder)
    return reduction.project(block, "item_id", reduction.fit_pca(block, len(NUMERIC), len(NUMERIC)))


@query("pca_variance")
def pca_variance(spark, folder):
    """Explained and cumulative variance ratio of each component."""
    block, _ = item_numbers(spark, folder)
    model = reduction.fit_pca(block, len(NUMERIC), len(NUMERIC))
    return reduction.cumulative(reduction.spectrum(spark, model.variance_ratio))


@query("pca_components_for_share")
def pca_components_for_share(spark, folder):
    return reduction.components_for_share(pca_variance(spark, folder), feature_plan.PCA_SHARES)


@query("pca_reconstruction")
def pca_reconstruction(spark, folder):
    """Error left by each number of components."""
    block, _ = item_numbers(spark, folder)
    model = reduction.fit_pca(block, len(NUMERIC), len(NUMERIC))
    errors = [
        reduction.reconstruction_error(block, reduction.project(block, "item_id", model.first(k)), model.first(k)).withColumn("components", F.lit(k))
        for k in range(1, len(NUMERIC) + 1)
    ]
    out = errors[0]
    for e in errors[1:]:
        out = out.unionByName(e)
    return out


@query("pca_scatter")
def pca_scatter(spark, folder):
    """First two components of every item with its vote rate (0 without reviews)."""
    block, joined = item_numbers(spark, folder)
    points = reduction.project(block, "item_id", reduction.fit_pca(block, len(NUMERIC), 2))
    rates = joined.select("item_id", F.coalesce("voted_up_rate", F.lit(0.0)).alias("voted_up_rate"))
    return points.join(rates, "item_id").select(
        "item_id", F.col("vec")[0].alias("pc1"), F.col("vec")[1].alias("pc2"), "voted_up_rate"
    )


def _text_rows(spark, folder):
    docs = tables.documents(spark, folder)
    weights, vocab = text.text_block(docs, "doc_id")
    return spill(labels.sparse_rows(weights, "doc_id", "weight", keys=docs), "text-rows", "doc_id"), vocab.count()


def _text_svd(spark, folder):
    rows, width = _text_rows(spark, folder)
    model = reduction.fit_svd(rows, width, 200)
    projected = spill(reduction.project(rows, "doc_id", model), "svd")
    return rows, projected, reduction.svd_variance(rows, projected, model)


@query("svd_text")
def svd_text(spark, folder):
    return _text_svd(spark, folder)[1]


@query("svd_variance")
def svd_variance(spark, folder):
    return reduction.cumulative(reduction.spectrum(spark, _text_svd(spark, folder)[2].variance_ratio))


@query("svd_components_for_share")
def svd_components_for_share(spark, folder):
    return reduction.components_for_share(svd_variance(spark, folder), feature_plan.SVD_SHARES)


@query("svd_reconstruction")
def svd_reconstruction(spark, folder):
    return reduction.reconstruction_error(*_text_svd(spark, folder))


@query("svd_spectrum")
def svd_spectrum(spark, folder):
    """Singular values and their cumulative squared share within the retained part."""
    rows, width = _text_rows(spark, folder)
    model = reduction.fit_svd(rows, width, 200)
    values = reduction.spectrum(spark, model.singular_values, "singular_value")
    return values.join(reduction.cumulative(reduction.spectrum(spark, reduction.singular_shares(model))), "component")


def _space(spark, folder):
    return segment_plan.tag_space(tables.catalog(spark, folder), "item_id", parser=segment_labels)


@query("svd_tags")
def svd_tags(spark, folder):
    return _space(spark, folder).svd


@query("content_vectors")
def content_vectors(spark, folder):
    pairs, _, _ = split(spark, folder)
    vectors, _ = feature_plan.content_vectors(
        tables.catalog(spark, folder), pairs.select("item_id").distinct(), content_blob()
    )
    return vectors


def _vector_points(spark, folder):
    rows = spill(tables.vectors(spark, folder).select("id", unit("vec").alias("vec")), "points", "id")
    return rows, rows.select(F.size("vec")).first()[0]


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    """Final segments of the vector table with distances."""
    rows, width = _vector_points(spark, folder)
    (fit,) = clustering.fit_kmeans(rows, "id", [KMeansSpec("final", 6)], width)
    return clustering.assign_nearest(rows, "id", fit.centres)


@query("kmeans_inertia")
def kmeans_inertia(spark, folder):
    rows, width = _vector_points(spark, folder)
    fits = clustering.fit_kmeans(rows, "id", [KMeansSpec(str(k), k) for k in segment_plan.SWEEP], width)
    return spark.createDataFrame([(f.spec.k, f.inertia) for f in fits], "k int, inertia double")


@query("cluster_ablation")
def cluster_ablation(spark, folder):
    """Tag rows raw, reduced, and reduced to unit length."""
    found = segment_plan.ablation(_space(spark, folder), "item_id")
    return spark.createDataFrame(found, "variant string, silhouette double, largest_share_pct double")


@query("k_sweep")
def k_sweep(spark, folder):
    space = _space(spark, folder)
    found = segment_plan.k_sweep(space.l2, "item_id", space.width)
    return spark.createDataFrame(found, "k int, inertia double, silhouette double, min_size long, max_size long")


def _final(spark, folder):
    space = _space(spark, folder)
    (fit,) = clustering.fit_kmeans(space.l2, "item_id", [KMeansSpec("final", 6)], space.width)
    return space, clustering.assign_nearest(space.l2, "item_id", fit.centres)


@query("final_clustering")
def final_clustering(spark, folder):
    return clustering.cluster_sizes(_final(spark, folder)[1])


@query("cluster_assignments")
def cluster_assignments(spark, folder):
    return _final(spark, folder)[1].select("item_id", "cluster")


@query("segment_profiles")
def segment_profiles(spark, folder):
    """Top tags by lift of the fitted segments."""
    space, assigned = _final(spark, folder)
    return clustering.cluster_profiles(spill(assigned, "assigned"), space.cells, "item_id")


@query("ari_stability")
def ari_stability(spark, folder):
    rows, width = _vector_points(spark, folder)
    scores = spill(clustering.stability(rows, "id", 6, [0, 1, 2, 3, 4], width), "ari")
    summary = clustering.stability_summary(scores).first().asDict()
    return scores.withColumns({name: F.lit(value) for name, value in summary.items()})


def _factors(spark, folder, k=10):
    pairs, train, held = split(spark, folder)
    train = spill(train, "train")
    return pairs, train, held, factorization.fit_factors(train, k)


def _start(table: str, key: str, letter: str) -> str:
    def uniform(draw: int) -> str:
        text = f"'42|{letter}|' || dim || '|{draw}|' || {key}"
        return f"((('0x' || substr(md5({text}), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE)"

    return (
        f"(SELECT {key}, dim, sqrt(-2 * ln({uniform(0)})) * cos({uniform(1)} * 2 * pi()) * 0.1::DOUBLE AS v "
        f"FROM (SELECT DISTINCT {key} FROM {table}), range(10) r(dim))"
    )


@query(
    "mf_first_step",
    f"""WITH {SPLIT},
    p AS {_start('train', 'user_id', 'p')}, q AS {_start('train', 'item_id', 'q')},
    e AS (SELECT t.user_id, t.item_id, 1 - sum(p.v * q.v) AS e, sum(p.v * p.v) AS l FROM train t
      JOIN p ON p.user_id = t.user_id JOIN q ON q.item_id = t.item_id AND q.dim = p.dim GROUP BY ALL),
    s AS (SELECT item_id, count(*) AS n, avg(l) + 0.01::DOUBLE AS c FROM e GROUP BY item_id),
    g AS (SELECT e.item_id, p.dim, sum(e.e * p.v) AS g FROM e JOIN p ON p.user_id = e.user_id GROUP BY ALL)
    SELECT q.item_id, q.dim::INT AS dim,
      {r6('q.v + (1 - pow(greatest(1 - 0.03::DOUBLE * c, 0), n)) / (n * c) * (g - n * 0.01::DOUBLE * q.v)')} AS value
    FROM q JOIN s ON s.item_id = q.item_id JOIN g ON g.item_id = q.item_id AND g.dim = q.dim""",
)
def mf_first_step(spark, folder):
    """Item factors after the first half epoch from the initial factors."""
    _, train, _ = split(spark, folder)
    grid = factorization.build_grid(train, "user_id", "item_id")
    users, items = (grid.start(side, 10, factorization.SEED) for side in (grid.users, grid.items))
    moved = grid.table(grid.move(users, items, 10, factorization.LEARNING_RATE, factorization.REGULARIZATION), 10)
    values = F.posexplode(F.array(*[f"q{j}" for j in range(10)])).alias("dim", "value")
    return moved.select("item_id", values).withColumn("value", S.rounded("value"))


@query("mf_factors")
def mf_factors(spark, folder):
    _, _, _, model = _factors(spark, folder)
    users = model.vectors("user").select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "mf")
    return users.unionByName(model.vectors("item").select(F.lit("item").alias("side"), F.col("item_id").alias("id"), "mf"))


@query("mf_loss_curve")
def mf_loss_curve(spark, folder):
    _, _, _, model = _factors(spark, folder)
    rows = [(i, loss, (model.losses[0] - loss) / model.losses[0]) for i, loss in enumerate(model.losses, 1)]
    return spark.createDataFrame(rows, "epoch int, loss double, relative_decrease double")


@query("mf_hr")
def mf_hr(spark, folder):
    pairs, train, held, model = _factors(spark, folder)
    ready = recommend_plan.evaluate_factors(model, pairs.select("item_id").distinct(), train, held)
    return evaluation.hit_rates(scoring.heldout_ranks(ready, [scoring.Blend("k=10")]), by=["config"])


@query("mf_sweep")
def mf_sweep(spark, folder):
    """Latent sizes 10, 20 and 50; the best by HR@10 is marked."""
    pairs, train, held = split(spark, folder)
    train = spill(train, "train")
    rates, _, best = recommend_plan.factor_sweep(train, held, pairs.select("item_id").distinct())
    return rates.drop("position").withColumn("best", F.col("config") == f"k={best}")
