"""Catalog CSV with quoted multi-line text cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfscout.sources.schema import ITEM_KEY


def _reader(spark: SparkSession):
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE")


def scan_catalog(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, key: str = ITEM_KEY
) -> DataFrame:
    """All columns as text under their header names; ``columns`` prunes the parse to a subset.

    Values are typed later by expressions that turn junk into NULL, so nothing is inferred here.
    """
    catalog = _reader(spark).csv(path)
    if columns is not None:
        missing = [c for c in columns if c not in catalog.columns]
        if missing:
            raise ValueError(f"catalog has no column {', '.join(missing)}")
        catalog = catalog.select(*columns)
    return catalog.withColumn(key, F.col(key).cast("string"))
