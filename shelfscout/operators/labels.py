"""Token vocabularies and multi-hot blocks, kept as long (item, token) tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.functions.tokens import all_labels, labels
from shelfscout.session import task_count


def item_tokens(
    catalog: DataFrame, key: str, columns: list[str], prefix: bool = True, parser: Callable[[str], Column] = labels
) -> DataFrame:
    """``(key, token)``, one row per occurrence."""
    return catalog.select(key, F.explode(all_labels(columns, prefix, parser)).alias("token"))


def vocabulary(tokens: DataFrame, min_freq: int, max_features: int | None) -> DataFrame:
    """Tokens seen at least ``min_freq`` times, at most the ``max_features`` most frequent, with a dense index.

    ``(token, n, idx)``; the index follows the token order. With ``max_features`` the result is bounded by
    it; without, by the number of occurrences divided by ``min_freq``.
    """
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= min_freq)
    if max_features is not None:
        counts = counts.orderBy(F.desc("n"), F.asc("token")).limit(max_features)
        kept = counts.agg(F.array_sort(F.collect_list(F.struct("token", "n"))).alias("kept"))
        return kept.select(F.posexplode("kept").alias("idx", "kept")).select("kept.token", "kept.n", "idx")
    from shelfscout.operators.ordered import with_position

    return with_position(counts, ["token"], "idx").withColumn("idx", F.col("idx").cast("int"))


def in_vocabulary(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    return tokens.join(vocab.select("token"), "token", "left_semi")


def multi_hot(tokens: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """Ones of the binary matrix: distinct ``(key, token, idx)``."""
    cells = tokens.join(vocab.select("token", "idx"), "token").select(key, "token", "idx")
    # Dealt out first: a task then compares its share of the cells, however many of them one scan or a coalesced partition would hold.
    return cells.repartition(task_count(tokens.sparkSession), key, "idx").distinct()


def matrix_density(cells: DataFrame, row: str, column: str, n_rows: int | None = None, n_columns: int | None = None) -> DataFrame:
    """Shape, number of ones and density; empty rows count only when ``n_rows`` is given."""
    rows = F.lit(n_rows) if n_rows is not None else F.count_distinct(row)
    columns = F.lit(n_columns) if n_columns is not None else F.count_distinct(column)
    shape = cells.agg(
        rows.cast("long").alias("n_rows"), columns.cast("long").alias("n_columns"), F.count("*").alias("nnz")
    )
    return shape.withColumn("density", F.col("nnz") / (F.col("n_rows") * F.col("n_columns")))


def sparse_rows(
    cells: DataFrame, key: str, value: str | None = None, index: str = "idx", keys: DataFrame | None = None
) -> DataFrame:
    """``(key, indices, values)`` sorted by index; a row is at most one entry per vocabulary token.

    With ``keys`` every one of them gets a row, empty where it has no cell.
    """
    weight = F.col(value).cast("double") if value else F.lit(1.0)
    entry = F.struct(F.col(index).cast("int").alias("i"), weight.alias("v"))
    packed = cells.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    rows = packed.select(key, F.col("e.i").alias("indices"), F.col("e.v").alias("values"))
    if keys is None:
        return rows
    return keys.select(key).join(rows, key, "left").select(
        key,
        F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("values", F.array().cast("array<double>")).alias("values"),
    )
