"""All stages in order, from raw files to recommendations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfscout.plans.eda import run_eda
from shelfscout.plans.features import Features, run_features
from shelfscout.plans.ingest import Ingested, run_ingest
from shelfscout.plans.recommend import Recommendation, run_recommendation
from shelfscout.plans.segments import Segments, run_segments
from shelfscout.sources import store
from shelfscout.sources.catalog import scan_catalog
from shelfscout.sources.schema import CATALOG_COLUMNS


@dataclass
class Everything:
    ingested: Ingested
    report: dict[str, DataFrame]
    features: Features
    segments: Segments
    recommendation: Recommendation


def run_everything(
    spark: SparkSession,
    reviews_root: str,
    catalog_path: str,
    out_folder: str,
    as_of: str,
    ingest: dict | None = None,
    features: dict | None = None,
    segments: dict | None = None,
    recommend: dict | None = None,
) -> Everything:
    """Each stage reads what the one before has written; the dicts are passed on to the stages."""
    processed = f"{out_folder}/processed"
    ingested = run_ingest(spark, reviews_root, catalog_path, processed, **(ingest or {}))
    enriched = spark.read.parquet(ingested.path)
    votes = store.votes_of(enriched)
    items = store.items_of(scan_catalog(spark, catalog_path, CATALOG_COLUMNS))
    return Everything(
        ingested,
        run_eda(enriched, playtime="author_playtime_forever"),
        run_features(spark, items, votes, f"{out_folder}/features", as_of, **(features or {})),
        run_segments(spark, items, f"{out_folder}/clustering", **(segments or {})),
        run_recommendation(spark, votes, items, f"{out_folder}/recommendation", **(recommend or {})),
    )
