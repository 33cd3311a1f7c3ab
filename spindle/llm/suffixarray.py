"""Suffix array of a byte string by induced sorting, in numpy, to a bounded depth.

The steps of induced sorting, each a pass over arrays instead of single suffixes:

* classify suffixes as S (smaller than the next) or L, and find the leftmost S of each
  run (LMS);
* sort the LMS substrings by one induction from unsorted LMS positions, and name them;
* sort the reduced string of names by doubling, until names differ or cover ``depth``
  bytes (suffixes equal that far may stay in any order);
* induce the order of all suffixes from the sorted LMS suffixes, linearly: buckets are
  walked up for L and down for S, each bucket in waves, since a suffix can only put a
  longer one into its own bucket when both start with the same byte.

``common_prefixes`` gives, in text order, the length that each suffix shares with its
predecessor in the array: where the predecessor moves on by one byte with the position,
one equal byte is left behind and the length is one less; only the others are compared.
"""

from __future__ import annotations

import numpy as np


def _next_change(x: np.ndarray) -> np.ndarray:
    """For each i the least j >= i with x[j] != x[j + 1] (the last index at the end)."""
    n = len(x)
    at = np.where(np.append(x[1:] != x[:-1], True), np.arange(n), n)
    return np.minimum.accumulate(at[::-1])[::-1]


def _deal(order: np.ndarray, text: np.ndarray, found: np.ndarray, slot: np.ndarray, step: int) -> None:
    """Put ``found`` into the buckets of their first bytes, in order, from ``slot`` in direction ``step``."""
    first = text[found]
    by = np.argsort(first, kind="stable")
    found, first = found[by], first[by]
    count = np.bincount(first, minlength=len(slot))
    begin = np.cumsum(count) - count
    order[slot[first] + step * (np.arange(len(found)) - begin[first])] = found
    slot += step * count


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix order that the given order of LMS positions induces."""
    n, ends = len(text), np.cumsum(sizes)
    starts = ends - sizes
    order = np.full(n, -1, np.int32)
    by_bucket = lms[np.argsort(text[lms], kind="stable")]
    lms_ends = np.cumsum(np.bincount(text[lms], minlength=len(sizes)))
    slot = starts.copy()
    for c in np.flatnonzero(sizes):
        at = starts[c]
        own = by_bucket[lms_ends[c - 1] if c else 0:lms_ends[c]]
        while at < slot[c] or own is not None:
            if at < slot[c]:
                seen, at = order[at:slot[c]], slot[c]
            else:
                seen, own = own, None
            before = seen[seen > 0] - 1
            before = before[~small[before]]
            if len(before):
                _deal(order, text, before, slot, 1)
    large_ends = slot
    slot = ends - 1
    for c in np.flatnonzero(sizes)[::-1]:
        at, large = ends[c] - 1, True
        while at > slot[c] or large:
            if at > slot[c]:
                seen, at = order[slot[c] + 1:at + 1][::-1], slot[c]
            else:
                seen, large = order[starts[c]:large_ends[c]][::-1], False
            before = seen[seen > 0] - 1
            before = before[small[before]]
            if len(before):
                _deal(order, text, before, slot, -1)
    order[0] = n - 1
    return order


def _sort_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names``, told apart by ``depth`` names at least."""
    n, width = len(names), 1
    rank = names.astype(np.int64)
    while True:
        behind = np.zeros(n, np.int64)
        if width < n:
            behind[:-width] = rank[width:] + 1
        key = rank * (rank.max() + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
        if width >= depth or rank[order[-1]] == n - 1:
            return order


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order of the bytes ``data``, right to ``depth`` bytes; without the empty suffix."""
    text = np.append(data.astype(np.int16) + 1, np.int16(0))
    n = len(text)
    if n == 1:
        return np.zeros(0, np.int32)
    change = _next_change(text)
    small = text[change] < text[np.minimum(change + 1, n - 1)]
    small[-1] = True
    lms = np.flatnonzero(np.append(False, small[1:] & ~small[:-1])).astype(np.int32)
    sizes = np.bincount(text, minlength=258)
    order = _induce(text, small, lms, sizes)

    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    follow = np.full(n, n - 1, np.int32)
    follow[lms[:-1]] = lms[1:]
    powers = np.full(n, np.uint64(0x100000001B3), np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    total = np.append(np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers))
    a, b = sorted_lms[:-1], sorted_lms[1:]
    size_a, size_b = follow[a] - a + 1, follow[b] - b + 1
    low, high = np.minimum(a, b), np.maximum(a, b)
    same = size_a == size_b
    sum_low = total[low + np.where(same, size_a, 0)] - total[low]
    sum_high = total[high + np.where(same, size_a, 0)] - total[high]
    same &= sum_low * powers[high - low] == sum_high
    name_of = np.zeros(n, np.int64)
    name_of[sorted_lms] = np.append(0, np.cumsum(~same)) if len(sorted_lms) else 0
    names = name_of[lms]
    if len(lms) and names.max() + 1 < len(lms):
        sorted_lms = lms[_sort_names(names, -(-depth // 2) + 1)]
    return _induce(text, small, sorted_lms, sizes)[1:]


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix, in text order, shares with its predecessor in ``order`` (the first: 0)."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    moves_on = np.zeros(n, bool)
    moves_on[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (data[:-1] == data[before[:-1]])
    heads = np.flatnonzero(~moves_on & (before >= 0))
    padded = np.append(data, np.zeros(16, np.uint8))
    word = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    shared = np.zeros(n, np.int64)
    live, done = heads, 0
    while len(live):
        x, y = word[live + done], word[before[live] + done]
        differ = x ^ y
        equal = differ == 0
        lowest = differ[~equal] & (~differ[~equal] + np.uint64(1))
        shared[live[~equal]] = done + np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
        live, done = live[equal], done + 8
        over = np.maximum(live, before[live]) + done >= n
        shared[live[over]] = done
        live = live[~over]
    shared = np.minimum(shared, np.where(before >= 0, n - np.maximum(np.arange(n), before), 0))
    head_of = np.maximum.accumulate(np.where(moves_on, 0, np.arange(n)))
    return np.maximum(shared[head_of] - (np.arange(n) - head_of), 0)
