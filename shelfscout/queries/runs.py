"""Whole stages on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfscout.functions import scalars as S
from shelfscout.functions.tokens import content_blob
from shelfscout.plans.eda import run_eda
from shelfscout.plans.features import run_features
from shelfscout.plans.ingest import run_ingest
from shelfscout.plans.recommend import run_recommendation
from shelfscout.plans.segments import run_segments
from shelfscout.queries.aggregates import ENRICHED, enriched
from shelfscout.queries.files import FOLDER_KEY, REVIEWS, land_catalog, land_reviews
from shelfscout.queries.registry import query
from shelfscout.session import scratch_path
from shelfscout.sources import tables

INGESTED = f"""r AS ({REVIEWS}),
i AS (SELECT "AppID", count(*) AS n, sum(voted_up::INT)::BIGINT AS n_up, any_value(p_name) AS name FROM r JOIN part ON p_partkey = "AppID"::BIGINT GROUP BY 1)"""


def _ingest(spark, folder, **options):
    done = run_ingest(
        spark, land_reviews(spark, folder), land_catalog(spark, folder), scratch_path(spark, "processed"),
        key_pattern=FOLDER_KEY, **options,
    )
    return spark.read.parquet(done.path).groupBy("AppID").agg(
        F.count("*").alias("n"), F.sum(S.vote_int("voted_up")).alias("n_up"), F.first("name").alias("name")
    )


@query("ingest_run", f"WITH {INGESTED} SELECT * FROM i")
def ingest_run(spark, folder):
    """All files, joined with the catalog and written."""
    return _ingest(spark, folder)


@query(
    "ingest_sampled_run",
    f"""WITH {INGESTED}, c AS (SELECT p_partkey AS item_id, coalesce(n, 0) AS n FROM part LEFT JOIN i ON p_partkey = "AppID"::BIGINT),
    q AS (SELECT quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.5) AS b, quantile_cont(n, 0.75) AS c FROM c),
    b AS (SELECT item_id, (n > a)::INT + (n > b AND b > a)::INT + (n > q.c AND q.c > b)::INT AS bin FROM c, q),
    s AS (SELECT item_id, row_number() OVER (PARTITION BY bin ORDER BY md5('42|' || item_id), item_id::VARCHAR) AS r,
      count(*) OVER (PARTITION BY bin) AS m FROM b)
    SELECT i.* FROM i JOIN s ON s.item_id = i."AppID"::BIGINT WHERE r <= round_even(0.1 * m, 0)""",
)
def ingest_sampled_run(spark, folder):
    """The files of a tenth of the items, drawn within popularity quartiles."""
    return _ingest(spark, folder, sample_frac=0.1)


@query("feature_run")
def feature_run(spark, folder):
    """Blocks, PCA and SVD of the catalog: the metric rows of the stage."""
    done = run_features(
        spark,
        tables.catalog(spark, folder),
        tables.interactions(spark, folder),
        scratch_path(spark, "features"),
        as_of="2024-06-01",
        numeric_columns=["price", "size", "reviews_count", "voted_up_rate", "playtime_mean", "playtime_median"],
        text_columns=["name", "short_description", "developers"],
        include_review_aggregates=True,
    )
    return done.metrics


@query("clustering_run")
def clustering_run(spark, folder):
    done = run_segments(
        spark, tables.catalog(spark, folder), scratch_path(spark, "segments"), numeric_columns=["price", "size"]
    )
    return done.metrics


@query("recommendation_run")
def recommendation_run(spark, folder):
    """All four systems: hit rates side by side."""
    done = run_recommendation(
        spark,
        tables.interactions(spark, folder),
        tables.catalog(spark, folder),
        scratch_path(spark, "recommendation"),
        blob=content_blob(),
        popularity_column=None,
    )
    return done.comparison


@query(
    "eda_run",
    f"""WITH {ENRICHED} SELECT * FROM (
      SELECT 'votes' AS report, CASE WHEN voted_up THEN 'Recommended' ELSE 'Not recommended' END AS label, count(*)::DOUBLE AS value FROM enriched GROUP BY 2
      UNION ALL SELECT 'raw_votes', voted_up::VARCHAR, count(*) FROM enriched GROUP BY 2
      UNION ALL (SELECT 'top_items', name, count(*) FROM enriched GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15)
      UNION ALL (SELECT 'vote_rates', name, round(r, 6) + 0.0 FROM (SELECT name, avg(voted_up::INT) * 100 AS r, count(*) AS n FROM enriched
        GROUP BY name ORDER BY n DESC, name LIMIT 15))
      UNION ALL (WITH q AS (SELECT quantile_cont(playtime::DOUBLE, 0.99) AS cap, min(playtime)::DOUBLE AS lo FROM enriched)
        SELECT 'playtime', least(floor((least(playtime::DOUBLE, cap) - lo) / ((cap - lo) / 60)), 59)::INT::VARCHAR, count(*) FROM enriched, q GROUP BY 2)
      UNION ALL (SELECT 'top_genres', trim(genres), count(*) FROM enriched GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 15))""",
)
def eda_run(spark, folder):
    """The labelled tables of the exploratory report, one under the other."""
    report = run_eda(enriched(spark, folder))
    shown = {"votes": ("label", "n"), "raw_votes": ("vote", "n"), "playtime": ("bin", "n"), "top_items": ("name", "n"), "vote_rates": ("name", "rate"), "top_genres": ("genre", "n")}
    parts = [
        report[name].select(F.lit(name).alias("report"), F.col(label).cast("string").alias("label"), S.rounded(F.col(value).cast("double")).alias("value"))
        for name, (label, value) in shown.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
