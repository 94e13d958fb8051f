"""Stage 1: raw review files and catalog to one enriched table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscout.functions.scalars import clean_number
from shelfscout.operators.reviews import enrich
from shelfscout.operators.sampling import popularity_sample
from shelfscout.session import configure
from shelfscout.sources.catalog import scan_catalog
from shelfscout.sources.reviews import FILE_NAME_KEY, scan_reviews
from shelfscout.sources.schema import ITEM_KEY
from shelfscout.sources.store import interactions_name, write_table


@dataclass
class Ingested:
    path: str
    count: int
    quarantine: DataFrame


def sampled_items(spark: SparkSession, catalog_path: str, fraction: float, seed: int) -> DataFrame:
    """Catalog keys sampled within quartiles of the number of reviews (missing counts as 0)."""
    counts = scan_catalog(spark, catalog_path, [ITEM_KEY, "num_reviews_total"]).select(
        ITEM_KEY, F.coalesce(clean_number("num_reviews_total"), F.lit(0.0)).alias("n")
    )
    return popularity_sample(counts, "n", ITEM_KEY, fraction, seed).select(ITEM_KEY)


def run_ingest(
    spark: SparkSession,
    reviews_root: str,
    catalog_path: str,
    out_folder: str,
    limit_files: int | None = None,
    sample_frac: float | None = 1.0,
    seed: int = 42,
    key_pattern: str = FILE_NAME_KEY,
    multi_line: bool = False,
) -> Ingested:
    """All files, the first ``limit_files``, or the files of a popularity sample; inner join with the catalog.

    Limited and sampled runs write the sample table, a full run the full one.
    """
    configure(spark)
    full = limit_files is None and sample_frac in (None, 1, 1.0)
    items = None
    if limit_files is None and not full:
        items = sampled_items(spark, catalog_path, sample_frac, seed)
    scan = scan_reviews(spark, reviews_root, key_pattern, limit_files, items, multi_line)
    catalog = scan_catalog(spark, catalog_path, [ITEM_KEY, "name", "genres", "tags"])
    enriched = enrich(scan.rows, catalog, ITEM_KEY, ["name", "genres", "tags"])
    path = write_table(enriched, f"{out_folder}/{interactions_name(full)}", cluster_by=ITEM_KEY)
    return Ingested(path, spark.read.parquet(path).count(), scan.quarantine)
