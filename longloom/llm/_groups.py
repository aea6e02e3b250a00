"""Groups of rows handed to a function inside mapInArrow, without a task per group.

Rows arrive sorted by their key columns; a group may span Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None

    def edge(batch: pa.RecordBatch, row: int):
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        turn = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(k).to_numpy(zero_copy_only=False)
            turn[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(turn).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            key = edge(batch, start)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def root(parent: dict, x: int) -> int:
    """The root of ``x`` in a forest of joined sets; paths are halved on the way."""
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x
