"""Clustering steps, profiles and validation on the vector table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from shelfscout.functions import scalars as S, tokens as T
from shelfscout.functions.vectors import on_grid
from shelfscout.operators import clustering
from shelfscout.operators.sampling import fixed_sample
from shelfscout.queries.registry import CATALOG, query, r6
from shelfscout.sources import tables

K, SEEDS = 6, [1, 2, 3, 4, 5]


def points(spark, folder):
    return tables.vectors(spark, folder).withColumn("vec", on_grid("vec"))


def width_of(rows) -> int:
    return rows.select(F.size("vec")).first()[0]


def starts(rows, seed: int) -> np.ndarray:
    return np.array([r["vec"] for r in fixed_sample(rows.select("id", "vec"), "id", K, seed).collect()])


SNAP = "list_transform({0}, lambda x: floor(x * 1048576 + 0.5) / 1048576)"
VALUES = ", ".join(f"({s})" for s in SEEDS)
DISTANCE = "list_sum(list_transform(list_zip(p.vec, c.vec), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
STEP = f"""pts AS (SELECT vec_id AS id, {SNAP.format('embedding::DOUBLE[]')} AS vec FROM embeddings),
seeds(seed) AS (VALUES {VALUES}),
c0 AS (SELECT seed, (r - 1)::INT AS cluster, vec FROM (
  SELECT seed, id, vec, row_number() OVER (PARTITION BY seed ORDER BY md5(seed || '|' || id), id) AS r FROM pts, seeds) WHERE r <= {K}),
a0 AS (SELECT seed, id, vec, cluster, d2 FROM (
  SELECT seed, p.id, p.vec, cluster, {DISTANCE} AS d2,
    row_number() OVER (PARTITION BY seed, p.id ORDER BY {DISTANCE}, cluster) AS r FROM pts p, c0 c) WHERE r = 1),
moved AS (SELECT seed, cluster, list(m ORDER BY dim) AS vec FROM (
  SELECT seed, cluster, dim, avg(x) AS m FROM (
    SELECT seed, cluster, unnest(vec) AS x, generate_subscripts(vec, 1) AS dim FROM a0) GROUP BY ALL) GROUP BY ALL),
c1 AS (SELECT c0.seed, c0.cluster, coalesce(m.vec, c0.vec) AS vec FROM c0 LEFT JOIN moved m ON c0.seed = m.seed AND c0.cluster = m.cluster),
c1s AS (SELECT seed, cluster, {SNAP.format('vec')} AS vec FROM c1),
a1 AS (SELECT seed, p.id, min({DISTANCE}) AS d2 FROM pts p, c1s c GROUP BY ALL)"""


@query("assign_nearest", f"WITH {STEP} SELECT id, cluster, {r6('d2')} AS d2 FROM a0 WHERE seed = 1")
def assign_nearest(spark, folder):
    rows = points(spark, folder)
    return clustering.assign_nearest(rows, "id", starts(rows, 1)).withColumn("d2", S.rounded("d2"))


@query("cluster_sse", f"WITH {STEP} SELECT {r6('sum(d2)')} AS sse FROM a0 WHERE seed = 1")
def cluster_sse(spark, folder):
    rows = points(spark, folder)
    return clustering.cluster_sse(clustering.assign_nearest(rows, "id", starts(rows, 1))).select(S.rounded("sse").alias("sse"))


@query(
    "update_centroids",
    f"""WITH {STEP}, l AS (SELECT cluster, unnest(vec) AS x, (generate_subscripts(vec, 1) - 1)::INT AS dim FROM c1 WHERE seed = 1)
    SELECT cluster, dim, {r6('x')} AS value FROM l""",
)
def update_centroids(spark, folder):
    rows = points(spark, folder)
    centres, _, _ = clustering.cluster_means(rows, starts(rows, 1))
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cluster int, vec array<double>")
    return table.select("cluster", F.posexplode("vec").alias("dim", "value")).withColumn("value", S.rounded("value"))


@query(
    "lloyd_descent",
    f"""WITH {STEP}, b AS (SELECT seed, sum(d2) AS j FROM a0 GROUP BY seed), a AS (SELECT seed, sum(d2) AS j FROM a1 GROUP BY seed)
    SELECT b.seed, {r6('b.j')} AS j_before, {r6('a.j')} AS j_after, {r6('a.j - b.j')} AS delta_j, a.j <= b.j AS descent_ok
    FROM a JOIN b ON a.seed = b.seed""",
)
def lloyd_descent(spark, folder):
    steps = clustering.lloyd_descent(points(spark, folder), "id", K, SEEDS)
    return steps.select("seed", *[S.rounded(c).alias(c) for c in ("j_before", "j_after", "delta_j")], "descent_ok")


@query(
    "cluster_sizes",
    """SELECT label AS cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM embeddings), 6) + 0.0 AS share
    FROM embeddings GROUP BY label""",
)
def cluster_sizes(spark, folder):
    sizes = clustering.cluster_sizes(tables.vectors(spark, folder), "label")
    return sizes.select(F.col("label").alias("cluster"), "size", S.rounded("share").alias("share"))


@query(
    "silhouette_sampled",
    f"""WITH e AS (SELECT vec_id AS id, label, {SNAP.format('embedding::DOUBLE[]')} AS vec FROM embeddings),
    s AS (SELECT * FROM e ORDER BY md5('42|' || id), id LIMIT 10000),
    d AS (SELECT p.id, p.label AS own, c.label AS other, sum(sqrt({DISTANCE})) AS d, count(*) AS n FROM s p, s c GROUP BY ALL),
    v AS (SELECT id, max(n) FILTER (own = other) AS size, max(d / greatest(n - 1, 1)) FILTER (own = other) AS a,
      min(d / n) FILTER (own <> other) AS b FROM d GROUP BY id)
    SELECT {r6('avg(CASE WHEN size <= 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette, count(*) AS n FROM v""",
)
def silhouette_sampled(spark, folder):
    rows = tables.vectors(spark, folder)
    found = clustering.silhouette_sampled(
        rows.select("id", "vec"), rows.select("id", F.col("label").alias("cluster")), "id", width_of(rows)
    )
    return found.select(S.rounded("silhouette").alias("silhouette"), "n")


@query(
    "silhouette_full",
    f"""WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS vec FROM embeddings),
    d AS (SELECT p.id, p.label AS own, c.label AS other, sum({DISTANCE}) AS d, count(*) AS n FROM e p, e c GROUP BY ALL),
    v AS (SELECT id, max(n) FILTER (own = other) AS size, max(d / greatest(n - 1, 1)) FILTER (own = other) AS a,
      min(d / n) FILTER (own <> other) AS b FROM d GROUP BY id)
    SELECT {r6('avg(CASE WHEN size <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM v""",
)
def silhouette_full(spark, folder):
    """Squared-Euclidean silhouette of all rows, linear in their number."""
    rows = tables.vectors(spark, folder)
    value = clustering.silhouette_full(rows.select("id", "vec"), rows.select("id", F.col("label").alias("cluster")), "id")
    return spark.createDataFrame([(value,)], "silhouette double").select(S.rounded("silhouette").alias("silhouette"))


@query(
    "adjusted_rand",
    f"""WITH l AS (SELECT label AS a, label // 3 AS b FROM embeddings),
    c AS (SELECT a, b, count(*)::DOUBLE AS n FROM l GROUP BY ALL), t AS (SELECT sum(n) AS t, sum(n * (n - 1) / 2) AS ab FROM c),
    ra AS (SELECT sum(n * (n - 1) / 2) AS a2 FROM (SELECT sum(n) AS n FROM c GROUP BY a)),
    rb AS (SELECT sum(n * (n - 1) / 2) AS b2 FROM (SELECT sum(n) AS n FROM c GROUP BY b))
    SELECT {r6('(ab - a2 * b2 / (t * (t - 1) / 2)) / ((a2 + b2) / 2 - a2 * b2 / (t * (t - 1) / 2))')} AS ari FROM t, ra, rb""",
)
def adjusted_rand(spark, folder):
    """The given partition against a coarser one."""
    both = tables.vectors(spark, folder).select(F.col("label").alias("a"), F.floor(F.col("label") / 3).alias("b"))
    return clustering.adjusted_rand(both, "a", "b").select(S.rounded("ari").alias("ari"))


@query(
    "cluster_profiles",
    f"""WITH {CATALOG}, asg AS (SELECT item_id, ((size - 1) // 9)::INT AS cluster FROM catalog),
    cells AS (SELECT item_id, split_part(name, ' ', 1) AS token FROM catalog UNION SELECT item_id, split_part(name, ' ', 2) FROM catalog
      UNION SELECT item_id, lower(developers) FROM catalog),
    z AS (SELECT cluster, count(*) AS size, count(*) / (SELECT count(*) FROM catalog) AS share FROM asg GROUP BY cluster),
    n AS (SELECT token, cluster, count(*) AS n FROM cells JOIN asg USING (item_id) GROUP BY ALL),
    t AS (SELECT token, sum(n) AS total FROM n GROUP BY token),
    r AS (SELECT cluster, size, share, token, (n / size) / (total / (SELECT count(*) FROM catalog)) AS lift, n / size AS cluster_freq
      FROM n JOIN t USING (token) JOIN z USING (cluster)),
    o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, token) AS rank FROM r)
    SELECT cluster, size, {r6('share')} AS share, token, {r6('lift')} AS lift, {r6('cluster_freq')} AS cluster_freq, rank::INT AS rank
    FROM o WHERE rank <= 5""",
)
def cluster_profiles(spark, folder):
    """Lift of clean tags and makers over segments by size."""
    catalog = tables.catalog(spark, folder)
    segments = catalog.select("item_id", F.floor((F.col("size") - 1) / 9).cast("int").alias("cluster"))
    tokens = F.concat(T.clean_tags("tags"), F.array(F.lower("developers")))
    cells = catalog.select("item_id", F.explode(tokens).alias("token")).distinct()
    found = clustering.cluster_profiles(segments, cells, "item_id")
    return found.select(
        "cluster", "size", S.rounded("share").alias("share"), "token", S.rounded("lift").alias("lift"),
        S.rounded("cluster_freq").alias("cluster_freq"), "rank",
    )

