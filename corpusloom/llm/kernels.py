"""Vectorised NumPy kernels over concatenated texts: fingerprints, words, sliding minima.

A text column of an Arrow batch is handled as one byte buffer plus document offsets, so a kernel
costs some nanoseconds a byte and no Python object is made for each word or document.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.Generator(np.random.PCG64(20240117)).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

#: True for space, tab, newline, vertical tab, form feed and carriage return, and no other byte.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.type in (pa.binary(), pa.large_binary())
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, U64(base))
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


class Prefix:
    """Prefix polynomial hashes of a sequence of 64-bit units; any slice's fingerprint in O(1)."""

    def __init__(self, units: np.ndarray):
        self.n = len(units)
        power, self.inverse = _power_tables(self.n)
        self.h = np.zeros(self.n + 1, U64)
        np.cumsum(units * power[: self.n], out=self.h[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.h[end] - self.h[start]) * self.inverse[start] + (end - start).astype(U64))

    def windows(self, k: int) -> np.ndarray:
        """Fingerprint of every slice of k units."""
        if self.n < k:
            return np.zeros(0, U64)
        return mix((self.h[k:] - self.h[:-k]) * self.inverse[: self.n + 1 - k] + U64(k))


def byte_units(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and offsets of each document in the list of words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Prefix(byte_units(data)).slices(start, end) if len(start) else np.zeros(0, U64)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (doubling, O(log width) passes)."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The integers of every half-open range [start, start + length), concatenated."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(start, np.int64) - first, length)


def doc_slices(offsets: np.ndarray, limit: int):
    """Consecutive document ranges [i, j) of at most ``limit`` units each, or of one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def tame_memory() -> None:
    """Have the C allocator keep a small heap: very large arrays are mapped, and what is free goes back."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 16 << 20)  # M_TRIM_THRESHOLD
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
    pa.default_memory_pool().release_unused()
