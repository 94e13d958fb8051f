"""Rows as NumPy chunks inside tasks, for dense and for sparse vector columns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Values held at once while a batch is worked through.
CHUNK_VALUES = 4_000_000


def chunks(batch: pa.RecordBatch, width: int, column: str = "vec") -> Iterator[tuple[int, np.ndarray]]:
    """``(first row, rows x width)`` pieces of a batch.

    The batch has a ``column`` of lists, or the pair ``indices`` / ``values`` of a sparse row.
    """
    step = max(1, CHUNK_VALUES // max(width, 1))
    if column in batch.schema.names:
        cells = batch.column(column)
        values = np.asarray(cells.flatten(), dtype=np.float64).reshape(batch.num_rows, width)
        for first in range(0, batch.num_rows, step):
            yield first, values[first : first + step]
        return
    lists = batch.column("indices")
    places, values = np.asarray(lists.flatten()), np.asarray(batch.column("values").flatten())
    sizes = np.asarray(lists.value_lengths())
    ends = np.cumsum(sizes)
    for first in range(0, batch.num_rows, step):
        last = min(first + step, batch.num_rows)
        lo, hi = ends[first] - sizes[first], ends[last - 1]
        piece = np.zeros((last - first, width))
        piece[np.repeat(np.arange(last - first), sizes[first:last]), places[lo:hi]] = values[lo:hi]
        yield first, piece


@dataclass
class SparsePiece:
    """Some rows of a batch: for each stored value its row within the piece, its column and the value, row by row."""

    first: int
    rows: int
    owner: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def times(self, basis: np.ndarray) -> np.ndarray:
        """rows x size: the rows times ``basis``, from the stored values alone."""
        return _segment_sums(self.values[:, None] * basis[self.places], self.owner, self.rows)

    def add_transposed(self, product: np.ndarray, total: np.ndarray) -> None:
        """Add the transposed rows times ``product`` (rows x size) to ``total`` (width x size)."""
        order = np.argsort(self.places, kind="stable")
        columns, number = np.unique(self.places[order], return_inverse=True)
        total[columns] += _segment_sums(self.values[order, None] * product[self.owner[order]], number, len(columns))


def _segment_sums(values: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Sums of the rows of ``values`` by their ascending ``owner``; owners without a row get zeros."""
    out = np.zeros((count, values.shape[1]))
    if len(owner):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def sparse_pieces(batch: pa.RecordBatch, size: int) -> Iterator[SparsePiece]:
    """Rows of ``indices`` / ``values`` in pieces whose products with ``size`` columns stay within ``CHUNK_VALUES``; a row is never cut."""
    lists = batch.column("indices")
    places, values = np.asarray(lists.flatten()), np.asarray(batch.column("values").flatten(), dtype=np.float64)
    # A NULL row has no values.
    ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
    step, first = max(1, CHUNK_VALUES // max(size, 1)), 0
    while first < batch.num_rows:
        start = ends[first - 1] if first else 0
        last = max(first + 1, min(int(np.searchsorted(ends, start + step, "right")), first + step, batch.num_rows))
        sizes = np.diff(ends[first:last], prepend=start)
        yield SparsePiece(first, last - first, np.repeat(np.arange(last - first), sizes), places[start : ends[last - 1]], values[start : ends[last - 1]])
        first = last


def double_lists(values: np.ndarray) -> pa.Array:
    """rows x width array to a list column."""
    rows, width = values.shape
    offsets = pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel()))
