"""Whole groups of sorted rows inside a ``mapInArrow`` task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def _cuts(table: pa.Table | pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Rows (but the first) that differ from the row before in a key."""
    n = table.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for k in keys:
        values = table.column(k)
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        codes = values.dictionary_encode().indices if not pa.types.is_integer(values.type) else values
        new |= np.diff(np.asarray(codes)) != 0
    return np.flatnonzero(new) + 1


def whole_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of rows equal in ``keys`` (no nulls), and where each run starts (and the last one ends).

    Rows come sorted by ``keys``. A table holds the runs that end in one batch,
    so memory is bounded by a batch and the longest run.
    """
    left: list[pa.RecordBatch] = []
    last = None

    def table() -> tuple[pa.Table, np.ndarray]:
        out = pa.Table.from_batches(left).combine_chunks()
        return out, np.concatenate([[0], _cuts(out, keys), [out.num_rows]])

    for b in batches:
        if not b.num_rows:
            continue
        new = _cuts(b, keys)
        if left and [b.column(k)[0] for k in keys] != last:
            yield table()
            left = []
        at = int(new[-1]) if len(new) else 0
        if at:
            left.append(b.slice(0, at))
            yield table()
            left = []
        left.append(b.slice(at))
        last = [b.column(k)[b.num_rows - 1] for k in keys]
    if left:
        yield table()


def joined_rows(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the links (a, b) connect it to."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root
