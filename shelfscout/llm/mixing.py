"""Mixing sources to target weights.

The words of each source are summed, the targets are filled by weight up to ``cap`` times the source, and every
document is emitted floor(rate) times plus one copy that a hash of the seed and its id draws with the
probability of the fraction, rate being target over source size.

Defined results: a NULL or blank text has size 0 and is emitted as often as its draw says; NULL is a source of its
own and the last one; an empty table gives an empty mix; repeated rows are rows of their own, with the same draw
when they share an id. Columns of the input that are named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.llm.common import WORD, named, others
from shelfscout.operators.ordered import with_position
from shelfscout.session import spill

SEED = 42
WEIGHTS = (1, 2, 3)
CAP = 3
ADDED = ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key only."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fill_targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``.

    All sizes are shared by weight; what exceeds ``cap`` sizes of a source is shared again by the weights of the
    others until none is above. One small aggregate per round, and a round caps one more source at least.
    """
    most = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        full = (F.col("weight") * F.lit(level) > most) if capped >= 0 else F.lit(False)
        held = sources.agg(
            F.count_if(full).alias("capped"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if held["capped"] == capped or not held["open"]:
            break
        level, capped = (total - held["given"]) / held["open"], held["capped"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), most.cast("double")))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    seed: int = SEED,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target`` of its source and ``copies`` to emit."""
    sized = docs.select(*others(docs, ADDED), word_count(named(text)).alias("size"))
    sources = spill(
        docs.select(named(source).alias("source"), word_count(named(text)).alias("n"))
        .groupBy("source").agg(F.sum("n").alias("source_size")),
        "sources",
    )
    placed = with_position(sources, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = spill(placed.select("source", "source_size", weight.cast("long").alias("weight")), "weights")
    targets = fill_targets(weighted, cap).select(
        F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_size"), F.col("target").alias("_mix_target")
    )
    rate = F.when(F.col("_mix_size") > 0, F.col("_mix_target") / F.col("_mix_size")).otherwise(F.lit(0.0))
    copies = (F.floor(rate) + (draw(seed, named(key)) < rate - F.floor(rate)).cast("long")).cast("int")
    return sized.join(targets, named(source).eqNullSafe(F.col("_mix_source"))).select(
        *others(docs, ADDED),
        "size",
        F.col("_mix_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        copies.alias("copies"),
    )


def emit(planned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each planned document ``copies`` times, with these columns."""
    return planned.select(*map(named, columns), F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).select(
        *map(named, columns)
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``."""
    free = {c: f"_in_{i}" for i, c in enumerate(docs.columns) if c.lower() in ADDED}
    return emit(plan_mix(docs.withColumnsRenamed(free), **options), [free.get(c, c) for c in docs.columns]).withColumnsRenamed(
        {v: k for k, v in free.items()}
    )
