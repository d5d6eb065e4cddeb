"""Suffix arrays by induced sorting, and permuted common prefixes; a bucket or text at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


def suffix_array(s: Sequence[int], size: int) -> list[int]:
    """Start positions of the suffixes of ``s`` (values below ``size``) in order.

    A suffix is of type S if it is smaller than the next one, else L. Sorting the S suffixes that
    follow an L suffix (leftmost smaller ones) induces all others: one pass from the left
    places the L suffixes at the fronts of their buckets, one from the right the S
    suffixes at the ends. The leftmost ones are ordered by the same two passes over their
    substrings, which are then named; where names repeat, the string of names is sorted by doubling.
    """
    n = len(s)
    if n < 2:
        return list(range(n))
    s = np.asarray(s, np.uint16 if size <= 1 << 16 else np.int64)
    new = np.flatnonzero(s[1:] != s[:-1]) + 1
    runs = np.append(0, new)
    lengths = np.diff(np.append(runs, n))
    # All of a run has the type of its last suffix; the last run counts as followed by less.
    smaller_run = np.append(s[new - 1] < s[new], False)
    leftmost = runs[1:][smaller_run[1:] & ~smaller_run[:-1]]
    before = np.arange(n) - np.repeat(runs, lengths)

    sa = _induced(s, size, leftmost, before)
    if len(leftmost) < 2:
        return sa.tolist()
    after = np.zeros(n, np.int64)
    after[leftmost] = np.append(leftmost[1:], n - 1)
    ordered = sa[after[sa] > 0]
    # The last piece ends with the string; it is like no other.
    sizes = after[ordered] - ordered + 1
    alike = (sizes[1:] == sizes[:-1]) & (ordered[1:] != leftmost[-1]) & (ordered[:-1] != leftmost[-1])
    at = np.flatnonzero(alike)
    if len(at):
        firsts = np.cumsum(sizes[at]) - sizes[at]
        place = np.arange(sizes[at].sum()) - np.repeat(firsts, sizes[at])
        equal = s[np.repeat(ordered[at], sizes[at]) + place] == s[np.repeat(ordered[at + 1], sizes[at]) + place]
        alike[at] = np.logical_and.reduceat(equal, firsts)
    names = np.zeros(n, np.int64)
    names[ordered] = np.append(0, np.cumsum(~alike))
    if alike.any():
        ordered = leftmost[_doubled(names[leftmost])]
    return _induced(s, size, ordered, before).tolist()


def _induced(s: np.ndarray, size: int, leftmost: np.ndarray, before: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the ``leftmost`` smaller ones, ordered within their buckets, induce.

    A bucket's entries are those that earlier buckets dealt to it, and what these induce in the bucket
    itself: the suffixes ``before`` them in a run of its value, first those one place
    before, then two, and so on. Entries before which there is another value go to its bucket, in order.
    """
    n = len(s)
    leftmost = leftmost[np.argsort(s[leftmost], kind="stable")]
    values = np.unique(s).tolist()
    bounds = np.searchsorted(s[leftmost], np.array([*values, size], np.int64)).tolist()

    def whole(chunks: list[np.ndarray]) -> np.ndarray:
        entries = np.concatenate(chunks) if chunks else np.zeros(0, np.int64)
        reps = before[entries] + 1
        total = int(reps.sum())
        if total == len(entries):
            return entries
        back = np.arange(total) - np.repeat(np.cumsum(reps) - reps, reps)
        order = np.argsort(back, kind="stable")
        return (np.repeat(entries, reps) - back)[order]

    def deal(sources: np.ndarray, value: int, larger: bool, buckets: dict[int, list[np.ndarray]]) -> None:
        sources = sources[sources > 0] - 1
        first = s[sources]
        wanted = first > value if larger else first < value
        sources, first = sources[wanted], first[wanted]
        if len(sources):
            order = np.argsort(first, kind="stable")
            sources, first = sources[order], first[order]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for bucket, part in zip(first[np.append(0, cuts)].tolist(), np.split(sources, cuts)):
                buckets[bucket].append(part)

    fronts: dict[int, list[np.ndarray]] = {value: [] for value in values}
    ends: dict[int, list[np.ndarray]] = {value: [] for value in values}
    fronts[int(s[n - 1])].append(np.array([n - 1]))
    large, sorted_parts = {}, []
    for k, value in enumerate(values):
        large[value] = whole(fronts.pop(value))
        deal(np.concatenate([large[value], leftmost[bounds[k] : bounds[k + 1]]]), value, True, fronts)
    for value in reversed(values):
        small = whole(ends.pop(value))
        sorted_parts += [small, large[value][::-1]]
        deal(np.concatenate(sorted_parts[-2:]), value, False, ends)
    return np.concatenate(sorted_parts)[::-1]


def _doubled(names: np.ndarray) -> np.ndarray:
    """The suffixes of a string of names in order: they are ranked by their first 1, 2, 4, ... names, each time
    only those that others still equal."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    open_, rank, width = order, np.zeros(n, np.int64), 1
    key, first = names[order], np.zeros(n, np.int64)
    while len(open_):
        # ``open_`` in order by key; ``first`` is the rank of the group each had before.
        new = np.append(True, key[1:] != key[:-1])
        heads = np.flatnonzero(new)
        group = np.append(True, first[1:] != first[:-1])
        starts = np.flatnonzero(group)
        place = np.arange(len(open_)) - np.repeat(starts, np.diff(np.append(starts, len(open_))))
        order[first + place] = open_
        sizes = np.diff(np.append(heads, len(open_)))
        rank[open_] = np.repeat((first + place)[heads], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        follows = open_ + width
        second = np.where(follows < n, rank[np.minimum(follows, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        open_, key, width = open_[by_key], key[by_key], width * 2
        first = rank[open_]
    return order


def common_prefixes(s: Sequence[int], sa: Iterable[int]) -> np.ndarray:
    """Per position in text order, the length of the prefix its suffix shares with the one before
    it in ``sa``. Where both come after the same value, it is one less than that of the position
    before; only the others are compared, four values at a time."""
    s, sa = np.asarray(s, np.int64), np.asarray(sa, np.int64)
    n = len(s)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    previous = np.full(n, -1)
    previous[sa[1:]] = sa[:-1]
    compared = np.ones(n, bool)
    compared[1:] = (previous[1:] <= 0) | (s[:-1] != s[previous[1:] - 1])
    at = np.flatnonzero(compared & (previous >= 0))
    step = 4 if s.min() >= 0 and s.max() < 1 << 16 else 1
    padded = np.append(s, np.zeros(step, np.int64)).astype(np.uint64)
    words = padded[:n].copy()
    for k in range(1, step):
        words |= padded[k : n + k] << np.uint64(16 * k)
    i, j, length = at, previous[at], 0
    while len(at):
        most = n - np.maximum(i, j) - length
        a, b = words[np.minimum(i + length, n - 1)], words[np.minimum(j + length, n - 1)]
        differs = a ^ b
        # Equal values from the first on, none beyond the end of the string.
        equal = np.where(differs == 0, step, 0)
        for k in range(1, step):
            equal = np.maximum(equal, np.where(differs & np.uint64((1 << 16 * k) - 1) == 0, k, 0))
        equal = np.minimum(equal, most)
        shared[at] = length + equal
        on = equal == step
        at, i, j, length = at[on], i[on], j[on], length + step
    # The others count down from the last one that was compared.
    last = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    return np.where(compared, shared, shared[last] - (np.arange(n) - last))
