"""Prefix trie of conversations by whole-sequence collapse.

``rebuild`` makes conversations anew from branches that start with turns of another one; ``prefix_trie`` takes any sequences of turns. Identical
sequences fall together first: each distinct one has a weight, its smallest conversation and the list of conversations that end there.
Sequences that are a proper prefix of another one go by anti-join; what stays are the leaves. Only then are prefixes made, of the distinct
sequences alone, and aggregated with the weights.

A prefix is known by its depth and 128 bits: the exclusive or of a hash of every (place, turn) in it. That needs no order, so long
conversations are folded in blocks of ``BLOCK`` turns and no task holds a whole one. Words saved by a subtree are sums over the same prefix rows: of the
weight times the words from a node to the end, less the words of the distinct nodes. A distinct node is counted by its owner, the sequence of the
smallest conversation through it; the nodes of an owner are the lower end of its path, so no ancestor lists are made. End lists, which
a third of all conversations may share, are sorted over the cluster and hashed as a stream of their parts.

Defined results: rows without conversation take no part; turns are ordered by turn, NULL first, then by the digest of role and text, so that ties and repeated
rows count and have one order; a NULL or empty role or text is empty; conversations without a turn end in the root; an empty table has no node.
Other columns play no part and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfscout.llm.common import WORD, named
from shelfscout.operators.ordered import _numbered, with_group_position
from shelfscout.session import spill, task_count

# Turns of one conversation that a task folds at once.
BLOCK = 4096
# A conversation branches off the one at the next lower multiple of BRANCHES, after fewer than HEADS turns.
BRANCHES, HEADS = 20, 4

KEY = ["depth", "k1", "k2"]


def digested(turns: DataFrame) -> DataFrame:
    """``(conv_id, at, digest, words)``: place in its conversation, digest of role and text and number of words, without the texts."""
    role, text = (F.coalesce(named(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = turns.where(named("conv_id").isNotNull()).select(
        named("conv_id").cast("long").alias("conv_id"),
        named("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        # Equal rows are told apart, so that many of them need not be sorted by one task.
        F.monotonically_increasing_id().alias("mark"),
    )
    held = spill(known, "turns")
    placed = with_group_position(held, ["conv_id"], [F.col("turn").asc_nulls_first(), "digest", "mark"], "at")
    return spill(placed.select("conv_id", "at", "digest", "words"), "placed")


def rebuild(placed: DataFrame, branches: int = BRANCHES, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, digest, words)`` of the rebuilt conversations, depth from 1, and all conversations.

    Conversation c begins with the first h turns of conversation c - c % ``branches`` and goes on after its own first h; h is the CRC-32 of the
    decimal c modulo ``heads``.
    """
    sizes = spill(placed.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    convs = sizes.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % branches).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shapes = spill(
        convs.join(bases, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "shapes"
    )
    starts = placed.where((F.col("at") < heads - 1) & (F.col("conv_id") % branches == 0)).withColumnRenamed("conv_id", "base")
    first = shapes.where("h > 0").join(starts, "base").where("at < h").select("conv_id", (F.col("at") + 1).alias("depth"), "digest", "words")
    own = placed.join(shapes, "conv_id").where("at >= h").select("conv_id", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "digest", "words")
    return spill(first.unionByName(own), "rebuilt"), shapes.select("conv_id")


def paths(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every prefix of every sequence: its key, its parent's key, the words of its last turn and of all its turns."""
    lane = lambda k: F.xxhash64(F.lit(k), "depth", "digest")
    rows = turns.select(
        "conv_id", "depth", "words", lane(1).alias("l1"), lane(2).alias("l2"), F.expr(f"(depth - 1) div {int(block)}").alias("block")
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    folded = rows.select(
        "conv_id", "depth", "words", "l1", "l2", "block",
        F.bit_xor("l1").over(upto).alias("k1"), F.bit_xor("l2").over(upto).alias("k2"), F.sum("words").over(upto).alias("upto"),
    )
    # Only sequences longer than a block have anything to carry: one row per block.
    blocks = spill(
        rows.groupBy("conv_id", "block").agg(F.bit_xor("l1").alias("b1"), F.bit_xor("l2").alias("b2"), F.sum("words").alias("b_words")), "blocks"
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = blocks.where("block > 0").select("conv_id").distinct()
    carried = (
        blocks.join(long, "conv_id", "left_semi")
        .select("conv_id", "block", *[f(c).over(before).alias(c) for f, c in ((F.bit_xor, "b1"), (F.bit_xor, "b2"), (F.sum, "b_words"))])
        .where("block > 0")
    )
    later = folded.where("block > 0").join(carried, ["conv_id", "block"]).select(
        "conv_id", "depth", "words", "l1", "l2", "block",
        F.col("k1").bitwiseXOR(F.col("b1")).alias("k1"), F.col("k2").bitwiseXOR(F.col("b2")).alias("k2"), (F.col("upto") + F.col("b_words")).alias("upto"),
    )
    return folded.where("block = 0").unionByName(later).select(
        "conv_id", *KEY, F.col("k1").bitwiseXOR(F.col("l1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("l2")).alias("p2"), "words", "upto"
    )


def _zero() -> Column:
    return F.lit(0).cast("long")


def collapsed(conversations: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences ``(rep, weight, *KEY, total)``, and ``(conv_id, *KEY)``: where each conversation ends."""
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*KEY, "upto"), "depth").alias("end"))
    at = lambda c: F.coalesce(F.col("end").getField(c), _zero())
    whole = conversations.join(last, "conv_id", "left").select("conv_id", *[at(c).alias(c) for c in KEY], at("upto").alias("total"))
    whole = spill(whole, "whole")
    sequences = whole.groupBy(*KEY, "total").agg(F.count("*").alias("weight"), F.min("conv_id").alias("rep"))
    return spill(sequences, "sequences"), whole.drop("total")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(*KEY, ends_sha256)``: SHA-256 of the ascending decimal ids that end in each node, comma-joined."""
    sorted_ids = _numbered(ends, [*KEY, "conv_id"])
    # A list goes through tasks in the parts it was sorted into; no row holds more than a part of it.
    parts = sorted_ids.groupBy(*KEY, "_part").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    parts = parts.select(*KEY, "_part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    streams = spill(parts, "ends").repartition(task_count(ends.sparkSession), *KEY).sortWithinPartitions(*KEY, "_part")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "ids")]
            done = []
            for *key, ids in zip(*columns):
                if key == now:
                    state.update(b"," + ids.encode())
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
            yield _digest_rows(done)
        if now is not None:
            yield _digest_rows([(*now, state.hexdigest())])

    return streams.mapInArrow(work, "depth long, k1 long, k2 long, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = [*KEY, "ends_sha256"], [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def prefix_trie(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Nodes of the trie of the sequences ``turns`` (conv_id, depth from 1, digest, words) of all ``conversations`` (conv_id).

    A node is named by its smallest conversation and its depth.
    """
    prefixes = spill(paths(turns, block), "paths")
    sequences, ends = collapsed(conversations, prefixes)
    of_rep = prefixes.withColumnRenamed("conv_id", "rep")
    mine = sequences.select("rep", "weight", "total", F.col("depth").alias("whole_depth"))
    zeros = [_zero().alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "words", "upto")]
    columns = ["rep", "weight", "total", "whole_depth", *KEY, "p1", "p2", "words", "upto"]
    rows = spill(mine.join(of_rep, "rep").select(*columns).unionByName(mine.select("*", *zeros).select(*columns)), "prefixes")

    longer = spill(rows.where("depth < whole_depth").select(*KEY).distinct(), "longer")
    leaves = sequences.join(longer, KEY, "left_anti").select("rep", F.lit(1).cast("long").alias("leaf"))
    owned = spill(
        rows.groupBy(*KEY).agg(F.min("rep").alias("rep"), F.min(F.col("upto") - F.col("words")).alias("before")), "owned"
    )
    top = owned.groupBy("rep").agg(F.min_by(F.struct("depth", "before"), "depth").alias("top"))
    facts = spill(sequences.select("rep").join(leaves, "rep", "left").join(top, "rep", "left"), "facts")

    rest = F.col("total") - F.col("upto") + F.col("words")
    own = F.when(F.col("top").isNull(), 0).when(F.col("depth") >= F.col("top.depth"), rest).otherwise(F.col("total") - F.col("top.before"))
    nodes = spill(
        rows.join(facts, "rep")
        .groupBy(*KEY)
        .agg(
            F.min(F.struct("rep", F.col("top.depth").alias("from"))).alias("owner"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.sum("weight").alias("n_convs"),
            F.sum(F.coalesce("leaf", _zero())).alias("n_leaves"),
            F.sum(F.col("weight") * rest - own).alias("saved_tokens"),
        )
        .select(*KEY, "p1", "p2", F.col("owner.rep").alias("conv_id"), F.col("owner.from").alias("from"), "n_convs", "n_leaves", "saved_tokens"),
        "nodes",
    )
    # Counted by parent with partial sums, so that a node with very many children is no hot key of a join.
    counted = nodes.select(*KEY, _zero().alias("child")).unionAll(
        nodes.where("depth > 0").select(F.col("depth") - 1, "p1", "p2", F.lit(1).cast("long"))
    )
    children = counted.groupBy(*KEY).agg(F.sum("child").alias("n_children"))
    # Below the top of its owner a node has its parent's owner; only the tops look their parent up.
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("found"))
    tops = nodes.where("depth > 0 AND depth = from").select(*KEY, "p1", "p2")
    parents = spill(tops.join(above, ["depth", "p1", "p2"]).select(*KEY, "found"), "parents")
    parent = F.when(F.col("depth") > F.col("from"), F.col("conv_id")).otherwise(F.col("found"))
    done = nodes.join(children, KEY).join(parents, KEY, "left").join(end_digests(ends), KEY, "left")
    return done.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    rebuilt, conversations = rebuild(digested(turns))
    return prefix_trie(rebuilt, conversations)
