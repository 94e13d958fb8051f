"""Every row of one side against every row of the other, block by block.

Scoring all items for a user, or all distances of a sample, needs each pair once but never a row per pair.
Both sides are packed into blocks of a fixed number of rows, and each pair of blocks is handled by one matrix product. ``pair`` makes a row
per pair of blocks. ``deal`` moves far less where both sides are large: groups of blocks make a grid of cells, a block goes once to each cell of its
group, and a task holds one group of the left side while the blocks of the right one pass by.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfscout.session import task_count

# A side of at most this many bytes is sent to every executor; a larger one is shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024
# A cell holds at most this much of the left side. There are about as many cells as shuffle partitions, but more than ``CELLS`` only where
# the left side asks for it: each further one is a further copy of blocks to move.
HELD_BYTES = 256 * 1024 * 1024
CELLS = 64
# What a row of a cell is, in the order they come.
LEFT, MASK, RIGHT = 0, 1, 2


def pack(df: DataFrame, block: str, vectors: Sequence[str], scalars: Sequence[str], order: str | None = None) -> DataFrame:
    """One row per ``block``: each scalar as an array, each vector column flattened, all in the same order.

    The caller sees to it that a block has a bounded number of rows. ``order`` names a scalar to sort by.
    """
    entry = F.struct(*scalars, *vectors)
    listed = F.collect_list(entry)
    rows = df.groupBy(block).agg((F.array_sort(listed, _by(order)) if order else listed).alias("_rows"))
    return rows.select(
        block,
        F.size("_rows").alias(f"{block}_size"),
        *[F.flatten(F.col(f"_rows.{v}")).alias(v) for v in vectors],
        *[F.col(f"_rows.{s}").alias(s) for s in scalars],
    )


def _by(order: str):
    return lambda a, b: F.when(a[order] < b[order], -1).when(a[order] > b[order], 1).otherwise(0)


def pair(
    left: DataFrame, right: DataFrame, n_left: int, n_right: int, right_bytes: int, masks: DataFrame | None = None
) -> DataFrame:
    """Join each ``_lb`` block with each ``_rb`` block; ``masks`` adds its columns to the pairs it names.

    Masks are put on the bare block numbers first, so that the vectors of a left block are moved once.
    """
    numbers = F.explode(F.sequence(F.lit(0), F.lit(max(n_right - 1, 0))))
    if masks is None:
        spread = left.withColumn("_rb", numbers)
    else:
        grid = left.select("_lb", numbers.alias("_rb")).join(masks, ["_lb", "_rb"], "left")
        spread = grid.join(left, "_lb")
    if right_bytes <= BROADCAST_BYTES:
        return spread.join(F.broadcast(right), "_rb")
    # Few right blocks would mean few join keys: copy each right block under several salts.
    tasks = task_count(left.sparkSession)
    salts = max(1, min(n_left, -(-4 * tasks // max(n_right, 1))))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_left = spread.withColumn("_salt", F.col("_lb") % F.lit(salts))
    return salted_left.join(salted_right.hint("shuffle_hash"), ["_rb", "_salt"]).drop("_salt")


def grid(n_left: int, n_right: int, left_bytes: int, right_bytes: int, tasks: int) -> tuple[int, int]:
    """Number of groups of each side: enough cells for the tasks, bounded groups on the left, and few bytes moved."""
    cells = min(tasks, CELLS)
    balanced = round(math.sqrt(cells * max(left_bytes, 1) / max(right_bytes, 1)))
    n_left_groups = min(n_left, max(balanced, -(-left_bytes // HELD_BYTES), 1))
    return n_left_groups, max(1, min(n_right, -(-cells // n_left_groups)))


def deal(
    left: DataFrame, right: DataFrame, n_left: int, n_right: int, left_bytes: int, right_bytes: int, masks: DataFrame | None = None
) -> DataFrame:
    """All blocks dealt to cells: ``_kind`` says what a row is, ``_at`` is -1 or its ``_rb``; columns of other kinds are NULL.

    A partition is one cell: first the blocks of its left group, then the right ones by number, each behind its rows of ``masks``.
    """
    rows, columns = grid(n_left, n_right, left_bytes, right_bytes, task_count(left.sparkSession))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    row, column = F.col("_lb") % rows, F.col("_rb") % columns

    def told(df: DataFrame, cell: Column, at: Column, kind: int) -> DataFrame:
        return df.withColumns({"_cell": cell.cast("int"), "_at": at.cast("int"), "_kind": F.lit(kind)})

    stream = told(left.withColumn("_to", every(columns)), row * columns + F.col("_to"), F.lit(-1), LEFT).drop("_to")
    passing = told(right.withColumn("_to", every(rows)), F.col("_to") * columns + column, F.col("_rb"), RIGHT).drop("_to")
    stream = stream.unionByName(passing, allowMissingColumns=True)
    if masks is not None:
        stream = stream.unionByName(told(masks, row * columns + column, F.col("_rb"), MASK), allowMissingColumns=True)
    return stream.repartitionById(rows * columns, F.col("_cell")).sortWithinPartitions("_cell", "_at", "_kind", "_lb")


def flat(column: pa.Array, row: int) -> np.ndarray:
    """Values of one list cell as an array."""
    cell = column[row]
    return np.asarray(cell.values) if cell.is_valid else np.empty(0)


def matrix(column: pa.Array, row: int, rows: int) -> np.ndarray:
    values = flat(column, row)
    return values.reshape(rows, -1)
