"""Suffix sort by prefix hashes: polynomial hashes and binary search give the common extension of two suffixes."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    if len(_powers.get(name, ())) < size:
        _powers[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size + (size >> 1), base)]))
    return _powers[name][:size]


class PrefixHashes:
    """Hashes of all prefixes of a byte buffer, modulo 2**64; the hash of any substring follows from two of them."""

    def __init__(self, data: np.ndarray):
        size = len(data)
        self.data = data
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", BASE, size))])
        self.down = _power("down", _INVERSE, size + 1)

    def grams(self, length: int) -> np.ndarray:
        """The hash of every substring of this length."""
        count = len(self.data) - length + 1
        return (self.prefix[length:] - self.prefix[:count]) * self.down[:count]

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[a + length] - self.prefix[a]) * self.down[a] == (self.prefix[b + length] - self.prefix[b]) * self.down[b]

    def common(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """How many bytes the suffixes at a and b share, up to the limit: a binary search for the longest equal prefix."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), limit)
        unsure = np.flatnonzero(~self.equal(a, b, high))
        low[np.setdiff1d(np.arange(len(a)), unsure, assume_unique=True)] = limit
        high[unsure] -= 1
        while len(unsure):
            middle = (low[unsure] + high[unsure] + 1) >> 1
            same = self.equal(a[unsure], b[unsure], middle)
            low[unsure[same]] = middle[same]
            high[unsure[~same]] = middle[~same] - 1
            unsure = unsure[low[unsure] < high[unsure]]
        return low

    def before(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Whether the suffix at a sorts before the one at b, by their first ``limit`` bytes."""
        shared = self.common(a, b, limit)
        inside = shared < limit
        result = np.zeros(len(a), bool)
        result[inside] = self.data[(a + shared)[inside]] < self.data[(b + shared)[inside]]
        return result


def merge_sort(hashes: PrefixHashes, places: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Sort the suffixes at ``places`` within each group (groups are contiguous) by their first ``limit`` bytes.

    A bottom-up mergesort, one level for all groups at a time. An element's place after a merge is its place in its
    own run plus the number of elements of the other run before it, found by binary search.
    """
    places = places.copy()
    size = len(places)
    index = np.arange(size)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if size else np.zeros(0, np.int64)
    number = np.cumsum(np.isin(index, first, assume_unique=True)) - 1
    start = first[number]
    stop = np.append(first[1:], size)[number]
    width, longest = 1, int((stop - start).max(initial=0))
    while width < longest:
        at = index - start
        run = at // width
        left = run % 2 == 0
        pair = start + (run - run % 2) * width
        low = np.where(left, pair + width, pair)
        high = np.minimum(np.where(left, pair + 2 * width, pair + width), stop)
        low = np.minimum(low, high)
        begin = low.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            mine, other = places[open_], places[middle]
            # equal suffixes keep their order: a left element goes before them, a right one after them
            passed = np.empty(len(open_), bool)
            on_left = left[open_]
            passed[on_left] = hashes.before(other[on_left], mine[on_left], limit)
            passed[~on_left] = ~hashes.before(mine[~on_left], other[~on_left], limit)
            low[open_[passed]] = middle[passed] + 1
            high[open_[~passed]] = middle[~passed]
            open_ = open_[low[open_] < high[open_]]
        merged = np.empty_like(places)
        merged[pair + (at % width) + (low - begin)] = places
        places = merged
        width *= 2
    return places


def repeated(hashes: PrefixHashes, places: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The places, sorted, whose first ``length`` bytes equal those of another place of their group, verified.

    Equal neighbours after the sort are equal by hash. Neighbouring places that match neighbouring places are
    one long match; its bytes are compared once.
    """
    if len(places) < 2:
        return np.zeros(0, np.int64)
    order = merge_sort(hashes, places, group, length)
    pairs = np.flatnonzero(group[1:] == group[:-1])
    a, b = order[pairs], order[pairs + 1]
    match = hashes.equal(a, b, np.full(len(a), length))
    a, b = np.minimum(a, b)[match], np.maximum(a, b)[match]
    by = np.lexsort((a, b - a))
    a, b = a[by], b[by]
    found = []
    heads = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)])) if len(a) else a
    for i, j in zip(heads, np.append(heads[1:], len(a)), strict=False):
        span = j - i - 1 + length
        if not np.array_equal(hashes.data[a[i] : a[i] + span], hashes.data[b[i] : b[i] + span]):
            return _by_bytes(hashes.data, places, group, length)
        found += [a[i:j], b[i:j]]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _by_bytes(data: np.ndarray, places: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """The same without hashes, for the case that two unlike strings had one hash."""
    seen: dict[tuple[int, bytes], list[int]] = {}
    for g, p in zip(group.tolist(), places.tolist(), strict=True):
        seen.setdefault((g, data[p : p + length].tobytes()), []).append(p)
    return np.unique(np.array([p for x in seen.values() if len(x) > 1 for p in x], np.int64))
