"""SimHash near-duplicates with pivot distance tables.

A fingerprint has one bit per majority of the 64-bit hashes of a text's word shingles. For every distinct fingerprint
the Hamming distances to a fixed set of reference fingerprints are computed once. Two fingerprints within ``RADIUS``
bits differ by at most ``RADIUS`` in each of these distances (triangle inequality), so a pair whose tables differ by more in any
coordinate is discarded before it is compared.

Pairs come from blocks: two of four quarters of the bits must agree. A block of up to ``block_rows`` fingerprints is
compared in memory; the members of larger ones are linked exactly through the points within one bit of them, of
which any two within two bits share one, and which at most 65 fingerprints share. Links become components
with the smallest id; nothing is dropped, and copies of one fingerprint are one node.

Defined results: NULL and blank texts have fingerprint zero and are linked by it; NULL ids never name a component unless
all its ids are NULL; repeated rows stay rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfscout.llm.common import named, packed, unpacked
from shelfscout.llm.components import components
from shelfscout.session import spill

SHINGLE = 3
HASH_SEED = 42
RADIUS = 2
PIVOTS = 16
BLOCK_ROWS = 512
QUARTER = 16


def _fingerprint(text: str | None, size: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles), ">u8", len(shingles))
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        raw = hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([_fingerprint(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    """The 64 bits as a long."""
    return F.pandas_udf(_fingerprints, T.LongType())(text)


def spelled(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: a fixed, spread set."""
    return [int(np.uint64(xxhash.xxh64_intdigest(f"pivot {i}")).view(np.int64)) for i in range(count)]


def pivot_table(bits: Column, count: int = PIVOTS) -> Column:
    return F.array(*[F.bit_count(bits.bitwiseXOR(F.lit(p))).cast("byte") for p in pivots(count)])


def _block_keys(bits: Column) -> Column:
    quarter = [F.shiftrightunsigned(bits, QUARTER * i).bitwiseAND(F.lit(0xFFFF)) for i in range(64 // QUARTER)]
    pairs = enumerate(combinations(range(len(quarter)), 2))
    return F.array(*[F.lit(t << 32) + quarter[i] * F.lit(1 << 16) + quarter[j] for t, (i, j) in pairs])


def _local_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the blocks of a stream that is sorted by block: each row with the first of its local component."""

    def linked(key: np.ndarray, bits: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
        first, left, right = np.arange(max(0, len(key) - 1)), [], []
        step = 1
        while len(first):
            first = first[first + step < len(key)]
            first = first[key[first] == key[first + step]]
            near = first[np.abs(table[first] - table[first + step]).max(axis=1, initial=0) <= RADIUS]
            near = near[np.bitwise_count(bits[near] ^ bits[near + step]) <= RADIUS]
            left.append(near)
            right.append(near + step)
            step += 1
        i, j = (np.concatenate(side) if side else np.empty(0, np.int64) for side in (left, right))
        label = np.arange(len(key))
        while True:
            low = np.minimum(label[i], label[j])
            new = label.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(key)))
        signed = bits.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        bits = batch.column(1).to_numpy().view(np.uint64)
        table = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int16).reshape(len(key), -1)
        # The last block may go on in the next batch.
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            held.append((key[:cut], bits[:cut], table[:cut]))
            yield linked(*(np.concatenate(c) for c in zip(*held)))
            held = []
        held.append((key[cut:], bits[cut:], table[cut:]))
    if held:
        yield linked(*(np.concatenate(c) for c in zip(*held)))


def links(prints: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(a, b)``: edges that connect exactly the distinct fingerprints (column ``bits``) within RADIUS bits."""
    keyed = prints.select("bits", pivot_table(F.col("bits")).alias("table"), F.explode(_block_keys(F.col("bits"))).alias("key"))
    # Written, so that the joins below meet two plain shuffles.
    shared = spill(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    small = keyed.join(shared.where(F.col("n") <= block_rows).select("key"), "key").select("key", "bits", "table")
    near = small.repartition("key").sortWithinPartitions("key").mapInArrow(_local_links, "a long, b long")
    crowded = keyed.select("key", "bits").join(shared.where(F.col("n") > block_rows).select("key"), "key").select("bits").distinct()
    flips = F.array(F.col("bits"), *[F.col("bits").bitwiseXOR(F.lit(int(np.uint64(1 << i).view(np.int64)))) for i in range(64)])
    # At most 65 fingerprints lie within one bit of a point.
    met = crowded.select("bits", F.explode(flips).alias("point")).groupBy("point").agg(F.collect_set("bits").alias("all"))
    star = met.where(F.size("all") > 1).select(F.explode("all").alias("a"), F.array_min("all").alias("b"))
    return near.unionAll(star)


def roots(prints: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(bits, root)`` for every distinct fingerprint."""
    found = components(links(prints, block_rows))
    return prints.select("bits").join(found, F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("root", "bits").alias("root")
    )


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``df``: ``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest key reachable)."""
    marked = spill(df.select(named(key).alias("key"), fingerprint(named(text)).alias("bits")), "prints")
    prints = spill(marked.groupBy("bits").agg(F.min("key").alias("first")), "distinct")
    rooted = spill(prints.join(roots(prints, block_rows), "bits"), "rooted")
    heads = spill(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "heads")
    groups = spill(rooted.join(heads, "root").select("bits", "component_id"), "groups")
    return marked.join(groups, "bits").select(F.col("key").alias(key), spelled(F.col("bits")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of ``df`` but for near-duplicates: of each group the row with the smallest key stays (NULL last)."""
    marked = spill(
        df.select(packed(df, ()).alias("row"), named(key).alias("key"), fingerprint(named(text)).alias("bits"),
                  F.monotonically_increasing_id().alias("place")),
        "marked",
    )
    place = F.struct(F.col("key").isNull().alias("void"), "key", "place")
    prints = spill(marked.groupBy("bits").agg(F.min(place).alias("first")), "distinct")
    rooted = prints.join(roots(prints, block_rows), "bits")
    kept = spill(rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.place"), "kept")
    return marked.join(kept, "place", "left_semi").select(*unpacked("row", df, ()))
