"""Texts of an Arrow batch as flat numpy arrays: words, hashes, windows.

Everything works on whole arrays, never on one character at a time. Hashes are polynomials modulo 2^64 over a fixed
table of random byte values, finished by a mixing step, so they depend on the bytes alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Bytes of a group after which free memory is given back.
LARGE_GROUP = 1 << 20
# Text bytes that are handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 16
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def give_back() -> None:
    """Return this process's free memory to the system: Spark keeps the process, and what it holds, for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` over the batches of a task, then give_back."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def giving_back_group(run: Callable) -> Callable:
    """``run`` for one group, then give_back if the group is large."""

    def whole(table: pa.Table) -> pa.Table:
        found = run(table)
        if table.nbytes >= LARGE_GROUP:
            give_back()
        return found

    return whole


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value per byte, the same for A-Z and a-z if ``lower``."""
    code = np.arange(256, dtype=np.uint64)
    if lower:
        code[65:91] += U64(32)
    return mix((code + U64(1)) * _BASE)


def is_space() -> np.ndarray:
    """Which bytes part words: the space and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base))
    out[:1] = 1
    return np.cumprod(out, out=out)


class Sums:
    """Hashes of any substrings of a byte array, from one running sum."""

    powers = _powers(int(_BASE), 1), _powers(int(_INVERSE), 1)

    def __init__(self, values: np.ndarray):
        n = len(values)
        if len(Sums.powers[0]) <= n:
            Sums.powers = _powers(int(_BASE), 2 * n), _powers(int(_INVERSE), 2 * n)
        power, self.back = Sums.powers
        self.total = np.empty(n + 1, np.uint64)
        self.total[0] = 0
        np.multiply(values, power[:n], out=self.total[1:])
        np.cumsum(self.total[1:], out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.total[end] - self.total[start]) * self.back[start]
        return mix(h + (end - start).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word, a longest run of bytes without white space."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    inside = ~is_space()[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    finish[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the number of the first word of each row (one entry more than rows)."""
    start, end, row = words(data, offsets)
    first = np.searchsorted(row, np.arange(len(offsets)))
    return Sums(byte_values(lower=True)[data]).hashes(start, end), first


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column with ``counts`` values per row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each row; a shorter text counts as one shingle."""
    h, first = word_hashes(data, offsets)
    n = max(0, len(h) - size + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams *= _BASE
        grams += h[k : k + n]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = U64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    whole = whole * _INVERSE + x
            out.append(mix(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
