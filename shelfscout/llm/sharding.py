"""Two-pass external shuffle into shards.

The first pass scatters the records by seeded hashes: the shard is the one with the highest hash of (id, shard), so
the id and the number of shards decide and one more shard only takes rows into itself; within a shard a second hash
of id and text picks one of enough buckets for each to fit into memory; a bucket that repeated rows make too large is
dealt out in parts. The second pass permutes each bucket (each part) with Spark's Fisher-Yates ``shuffle`` and writes it. What is returned is read from the written files, so the order is
fixed once and for all, whatever happens to an executor later.

Defined results: NULL ids fall into one shard by the same law, a NULL text counts 8 bytes; repeated rows take slots of
their own; an empty table gives an empty one. Columns named like an added one are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfscout.llm.common import named, others, packed, unpacked
from shelfscout.session import passing_tables, scratch_path, spill

SHARDS = 24
SEED = 42
BUCKET_BYTES = 16 << 20
# Low bits of a cell number: the part of the bucket.
PART_BITS = 32
ADDED = ("shard", "bucket", "slot")


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Highest random weight: growing from n to n + 1 shards moves rows into the new one only."""
    ranked = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), key, s), s.alias("s")))
    return F.array_max(ranked).getField("s").cast("int")


def scatter(
    df: DataFrame, shards: int, seed: int, bucket_bytes: int, key: str, text: str
) -> tuple[DataFrame, DataFrame, int]:
    """First pass: ``(cell, order, row)``, the rows per ``cell``, and the buckets of a shard. A cell is a bucket or a part of one.

    Rows of one id and text share a bucket, however many they are. A bucket that comes out too large for it is
    dealt out in parts by position and written, which fixes who is where; the others are one cell each.
    """
    volume = df.select(F.sum(record_size(named(text))).alias("n")).first()["n"] or 0
    per_shard = max(1, math.ceil(volume / shards / bucket_bytes))
    spread = F.pmod(F.xxhash64(F.lit(seed + 1), named(key), named(text)), F.lit(per_shard)).cast("int")
    bucket = (shard_of(named(key), shards, seed) * per_shard + spread).cast("int")
    found = spill(
        df.select(bucket.alias("bucket"), record_size(named(text)).alias("size"))
        .groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")),
        "buckets",
    )
    order = F.xxhash64(F.lit(seed + 2), named(key), named(text))
    # One column for both, so that grouping and join below go by the same hash and the rows move once.
    whole = F.shiftleft(F.col("bucket").cast("long"), PART_BITS).alias("cell")
    rows = df.select(bucket.alias("bucket"), order.alias("order"), packed(df, ADDED).alias("row"))
    large = spill(
        found.where((F.col("n") > 1) & (F.col("bytes") > 2 * bucket_bytes)).select("bucket", F.ceil(F.col("bytes") / bucket_bytes).alias("parts")),
        "large",
    )
    plain, sizes = rows.select(whole, "order", "row"), found.select(whole, "n")
    if not large.isEmpty():
        part = F.pmod(F.xxhash64(F.lit(seed + 3), F.monotonically_increasing_id()), F.col("parts"))
        dealt = spill(rows.join(large, "bucket").select((whole + part).alias("cell"), "order", "row"), "dealt")
        plain = rows.join(large, "bucket", "left_anti").select(whole, "order", "row").unionAll(dealt)
        sizes = found.join(large, "bucket", "left_anti").select(whole, "n").unionAll(dealt.groupBy("cell").agg(F.count("*").alias("n")))
    return plain, sizes, per_shard


def shuffle_into_shards(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Write ``df`` to ``path`` (one folder per shard) and read it back with ``shard``, ``bucket`` and ``slot``.

    ``slot`` counts from 0 in each shard without a gap. ``bucket_bytes`` bounds what one task shuffles at a time.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, "shards")
    with passing_tables(spark):
        rows, sizes, per_shard = scatter(df, shards, seed, bucket_bytes, key, text)
        bucket = F.shiftright("cell", PART_BITS).cast("int")
        # One row per cell: the volume over ``bucket_bytes`` in all.
        before = F.sum("n").over(
            Window.partitionBy(F.floor(bucket / per_shard)).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = spill(sizes.select("cell", F.coalesce(before, F.lit(0)).cast("long").alias("start")), "starts")

        scattered = rows.repartition(shards * per_shard, "cell").sortWithinPartitions("cell", "order")
        shuffled = (
            scattered.groupBy("cell").agg(F.collect_list("row").alias("rows"))
            .join(starts, "cell")
            .select(bucket.alias("bucket"), "start", F.posexplode(F.shuffle("rows", seed)).alias("place", "row"))
        )
        placed = shuffled.select(
            *unpacked("row", df, ADDED),
            F.floor(F.col("bucket") / per_shard).cast("int").alias("shard"),
            "bucket",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
        )
        placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(target)
    return spark.read.schema(placed.schema).parquet(target).select(*others(df, ADDED), *ADDED)
