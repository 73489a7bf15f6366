"""Hash-compared suffix sorting.

Two suffixes are compared by the length of their common extension, found by binary search over prefix
polynomial hashes, then by the first differing unit: O(log n) a comparison instead of O(n). A bottom-up
mergesort sorts many small lists of suffixes at once; equality is verified on the bytes.
"""

from __future__ import annotations

import numpy as np

from . import kernels as K


def common_extension(prefix: K.Prefix, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the longest common prefix, at most ``limit``, of the suffixes at a and b."""
    h, by_a, by_b = prefix.h, prefix.inverse[a], prefix.inverse[b]
    shift = h[a] * by_a - h[b] * by_b  # of equal prefixes, the difference of the scaled hashes
    low, high = np.zeros(len(a), np.int64), np.full(len(a), limit, np.int64)
    for _ in range(int(limit).bit_length()):
        middle = (low + high + 1) >> 1
        equal = h[a + middle] * by_a - h[b + middle] * by_b == shift
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return low


def compare(prefix: K.Prefix, values: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """-1, 0 or 1 for suffixes at a and b, of which ``limit`` units count."""
    common = common_extension(prefix, a, b, limit)
    differ = common < limit
    at = np.minimum(common, limit - 1)
    x, y = values[a + at], values[b + at]
    return np.where(differ, np.where(x < y, -1, 1), 0)


def sort_suffixes(prefix: K.Prefix, values: np.ndarray, suffix: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Order that sorts suffixes within each group; ``group`` must be non-decreasing."""
    n = len(suffix)
    order = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    begin, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    index = np.arange(n) - begin
    width = 1
    while n and width < sizes.max():
        run = index // width
        right = (run & 1) == 1
        other = np.where(right, run - 1, run + 1) * width
        moves = np.flatnonzero(other < size)
        if width == 1:  # pairs, compared once
            left = moves[~right[moves]]
            swap = left[compare(prefix, values, suffix[left], suffix[left + 1], limit) > 0]
            order[swap], order[swap + 1] = swap + 1, swap
            width = 2
            continue
        low = (begin + other)[moves]
        high = np.minimum(low + width, (begin + size)[moves])
        base, mine, is_right = low.copy(), suffix[order[moves]], right[moves]
        while (live := low < high).any():
            at = np.flatnonzero(live)
            middle = (low[at] + high[at]) >> 1
            c = compare(prefix, values, suffix[order[middle]], mine[at], limit)
            up = (c < 0) | ((c == 0) & is_right[at])  # equal suffixes keep their order
            low[at[up]], high[at[~up]] = middle[up] + 1, middle[~up]
        pair = (run[moves] & ~1) * width + begin[moves]
        target = np.arange(n)
        target[moves] = pair + (index[moves] - run[moves] * width) + (low - base)
        fresh = np.empty(n, np.int64)
        fresh[target] = order
        order = fresh
        width *= 2
    return order


def repeat_classes(units, window: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """A class number for each window of ``length`` units: equal windows of a group share one.

    Each group (``group`` is non-decreasing) is sorted as suffixes, which brings equal windows together; a
    class is a run of neighbours whose common extension is the whole window. The bytes are compared as well, so
    that a collision of hashes can't join different texts.
    """
    order = sort_suffixes(units.prefix, units.values, window, group, length)
    a, b = window[order[:-1]], window[order[1:]]
    same = group[order[1:]] == group[order[:-1]]
    same[same] = common_extension(units.prefix, a[same], b[same], length) == length
    same[same] = units.same(a[same], b[same], length)
    out = np.empty(len(window), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(~same)])
    return out
