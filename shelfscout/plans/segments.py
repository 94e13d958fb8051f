"""Stage 3: tag vectors, K-means segments, their profiles and their stability."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfscout.functions.tokens import clean_tags, has_tags, segment_labels
from shelfscout.functions.vectors import unit
from shelfscout.operators import clustering, labels, numeric, reduction
from shelfscout.operators.clustering import KMeansSpec
from shelfscout.plans.metrics import MetricLog
from shelfscout.session import configure, spill
from shelfscout.sources import store
from shelfscout.sources.schema import SEGMENT_COLUMNS

SWEEP = [4, 6, 8, 10]
VARIANTS = ["raw", "svd", "svd_l2"]


@dataclass
class Segments:
    assignments: DataFrame  # (key, cluster)
    profiles: DataFrame
    metrics: DataFrame
    written: list[str]


@dataclass
class TagSpace:
    """The three representations of the tag matrix, written, with their widths."""

    cells: DataFrame
    raw: DataFrame
    svd: DataFrame
    l2: DataFrame
    n_tags: int
    width: int


def tag_space(
    catalog: DataFrame, key: str, columns: list[str] | None = None, min_freq: int = 30, components: int = 50, parser=segment_labels
) -> TagSpace:
    """Binary tag rows of the tagged catalog, their SVD, and the SVD scaled to length one.

    ``parser=clean_tags`` leaves the vote counts of tag dicts out of the tokens.
    """
    tagged = catalog.where(has_tags("tags"))
    tokens = spill(labels.item_tokens(tagged, key, columns or SEGMENT_COLUMNS, prefix=False, parser=parser), "tags")
    vocabulary = spill(labels.vocabulary(tokens, min_freq, None), "tag-vocabulary")
    cells = spill(labels.multi_hot(tokens, vocabulary, key), "tag-cells")
    n_tags = vocabulary.count()
    rows = spill(labels.sparse_rows(cells, key, keys=tagged), "tag-rows", key)
    model = reduction.fit_svd(rows, n_tags, components)
    svd = spill(reduction.project(rows, key, model), "tag-svd", key)
    l2 = spill(svd.select(key, unit("vec").alias("vec")), "tag-l2", key)
    return TagSpace(cells, rows, svd, l2, n_tags, model.loadings.shape[1])


def ablation(space: TagSpace, key: str, k: int = 6, seed: int = 42, n_init: int = 10) -> list[tuple[str, float, float]]:
    """Silhouette and largest share (%) of the same K-means on each representation."""
    out = []
    for name, rows, width in zip(VARIANTS, (space.raw, space.svd, space.l2), (space.n_tags, space.width, space.width)):
        (fit,) = clustering.fit_kmeans(rows, key, [KMeansSpec(name, k, seed, n_init)], width)
        assigned = spill(clustering.assign_nearest(rows, key, fit.centres), "assigned")
        score = clustering.silhouette_sampled(rows, assigned, key, width).first()["silhouette"]
        out.append((name, score, float(fit.sizes.max() / fit.sizes.sum() * 100)))
    return out


def k_sweep(
    rows: DataFrame, key: str, width: int, ks: list[int] | None = None, seed: int = 42, n_init: int = 10
) -> list[tuple[int, float, float, int, int]]:
    """(K, inertia, silhouette, least size, greatest size); all K and restarts share the passes of one fit."""
    fits = clustering.fit_kmeans(rows, key, [KMeansSpec(str(k), k, seed, n_init) for k in ks or SWEEP], width)
    out = []
    for fit in fits:
        assigned = clustering.assign_nearest(rows, key, fit.centres)
        score = clustering.silhouette_sampled(rows, assigned, key, width).first()["silhouette"]
        out.append((fit.spec.k, fit.inertia, score, int(fit.sizes.min()), int(fit.sizes.max())))
    return out


def run_segments(
    spark: SparkSession,
    catalog: DataFrame,
    out_folder: str,
    key: str = "item_id",
    numeric_columns: list[str] | None = None,
    label_columns: list[str] | None = None,
    min_freq: int = 30,
    components: int = 50,
    k: int = 6,
    seed: int = 42,
    n_init: int = 10,
    clean: bool = True,
) -> Segments:
    """``clean`` reads tag dicts as tags; without it tokens keep the vote counts of the raw text."""
    configure(spark)
    log = MetricLog("clustering")
    space = tag_space(catalog, key, label_columns, min_freq, components, clean_tags if clean else segment_labels)
    log.add("", "n_items", space.raw.count())
    log.add("", "n_tag_dimensions", space.n_tags)
    log.add("", "svd_components", space.width)

    columns = numeric_columns or numeric.numeric_column_set(with_dates=False)
    block = numeric.as_array(numeric.numeric_block(catalog.where(has_tags("tags")), key, columns), key, columns)
    block = spill(block, "numeric", key)
    pca = reduction.fit_pca(block, len(columns), min(10, len(columns)))
    reduced = spill(reduction.project(block, key, pca), "pca10", key)
    for row in clustering.lloyd_descent(reduced, key, k, [1, 2, 3, 4, 5]).collect():
        for metric in ("j_before", "j_after", "delta_j"):
            log.add(f"lloyd_seed={row['seed']}", metric, round(row[metric], 0 if metric == "delta_j" else 1))
        log.add(f"lloyd_seed={row['seed']}", "descent_ok", row["descent_ok"])

    for name, score, share in ablation(space, key, k, seed, n_init):
        log.add(f"ablation={name}", "silhouette", round(score, 3))
        log.add(f"ablation={name}", "largest_cluster_share_pct", round(share, 1))
    for count, inertia, score, low, high in k_sweep(space.l2, key, space.width, SWEEP, seed, n_init):
        for metric, value in zip(("inertia", "silhouette", "min_size", "max_size"), (round(inertia), round(score, 4), low, high)):
            log.add(f"K={count}", metric, value)

    (final,) = clustering.fit_kmeans(space.l2, key, [KMeansSpec("final", k, seed, n_init)], space.width)
    assigned = spill(clustering.assign_nearest(space.l2, key, final.centres).select(key, "cluster"), "assigned")
    log.add("final", "inertia", round(final.inertia))
    score = clustering.silhouette_sampled(space.l2, assigned, key, space.width).first()["silhouette"]
    log.add("final", "silhouette", round(score, 4))
    for row in clustering.cluster_sizes(assigned).collect():
        log.add(f"final_cluster={row['cluster']}", "size", row["size"])
    profiles = clustering.cluster_profiles(assigned, space.cells, key)

    scores = spill(clustering.stability(space.l2, key, k, [0, 1, 2, 3, 4], space.width, n_init), "ari")
    log.add_row("ari", clustering.stability_summary(scores).first())
    for row in scores.collect():
        log.add(f"ari={row['seed_a']},{row['seed_b']}", "ari", round(row["ari"], 4))

    metrics = log.table(spark)
    written = [
        store.write_table(assigned, f"{out_folder}/cluster_assignments"),
        store.write_table(profiles, f"{out_folder}/cluster_profiles"),
        store.write_metrics(metrics, f"{out_folder}/metrics"),
    ]
    return Segments(assigned, profiles, metrics, written)
