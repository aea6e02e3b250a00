"""Word and shingle fingerprints over UTF-8 bytes, computed with numpy.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Those bytes never occur
inside a multi-byte character, so splitting bytes equals splitting text by
``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np

_CHUNK = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEPS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_space = np.zeros(256, dtype=bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32

_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i below ``size`` or more."""
    have = _powers.get((base, 0))
    if have is None or len(have[0]) < size:
        size = max(size, 2 * len(have[0]) if have else 1 << 12)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        have = _powers[(base, 0)] = (tables[0], tables[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (byte offsets) of the words of one text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_space[data]
    turns = np.diff(inside)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(_BASE, len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit fingerprint for each word of one text of any length.

    Long texts go through in pieces of about a megabyte, cut between words.
    """
    if len(data) <= _CHUNK:
        if lower:
            data = _lower[data]
        starts, ends = word_spans(data)
        return _span_hashes(data, starts, ends)
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + _CHUNK)
        if stop < len(data):
            gaps = np.flatnonzero(_space[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word longer than a piece: take it whole
                more = np.flatnonzero(_space[data[stop:]])
                stop = stop + int(more[0]) if len(more) else len(data)
        piece = data[at:stop]
        if lower:
            piece = _lower[piece]
        starts, ends = word_spans(piece)
        out.append(_span_hashes(piece, starts, ends))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int, family: int = 0) -> np.ndarray:
    """Fingerprints of the word windows [start, start + length)."""
    up, down = _power_tables(_STEPS[family], len(words) + 1)
    sums = np.empty(len(words) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts])


def all_windows(words: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """Fingerprints of all windows of ``size`` words; empty if the text is shorter."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return window_hashes(words, np.arange(n), size, family)


def shingles(data: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct fingerprints of the ``size``-word shingles of a lower-cased text.

    With fewer words the whole sequence is the one shingle; without words none.
    """
    words = word_hashes(data, lower=True)
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(all_windows(words, min(size, len(words))))


def texts(column):
    """The texts of an Arrow string column as byte arrays without copies; None for nulls."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield None if null is not None and null[i] else data[at[i] : at[i + 1]]


def freed() -> None:
    """Hand memory that this process no longer uses back to the system: idle workers count for their executor too."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def pieces(batches: Iterator, column: int | str, most: int = 4_000_000) -> Iterator:
    """``batches`` in slices of at most ``most`` bytes of text in ``column``, or of one row.

    What a function holds beside its batch then grows with a slice, not with
    the batch; unused memory goes back to the system behind the last one.
    """
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        past = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = past[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(past, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    freed()
