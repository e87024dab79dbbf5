"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard of bytes in memory.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The leftmost S of each run (LMS) starts a
substring; these are sorted by inducing, named, and where names repeat the string of names is sorted by the
same method. The sorted LMS suffixes then induce all others in one pass each way.

Small alphabets are induced by whole waves of a bucket at a time; long strings of names, whose buckets hold few
suffixes each, one suffix after the other. There the LMS substrings are sorted by their characters instead of a first
round of inducing; the order of the suffixes is induced from them all the same.
"""

from __future__ import annotations

import numpy as np

#: Alphabets above this are induced one suffix at a time.
WAVES_MOST = 1024


def smaller_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right; the last, empty of rivals, is."""
    n = len(s)
    if n == 1:
        return np.ones(1, bool)
    step = np.sign(s[1:].astype(np.int64) - s[:-1])
    # An equal neighbour has the type of the next unequal one.
    at = np.where(step != 0, np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(step[np.minimum(at, n - 2)] > 0, True)


def _places(order: np.ndarray, s: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where sorted suffixes go at the ends of their buckets."""
    chars = s[order]
    counts = np.bincount(chars, minlength=len(ends))
    first = np.cumsum(counts) - counts
    return ends[chars] - counts[chars] + np.arange(len(order)) - first[chars]


def _induce_by_waves(s, small, order, sizes) -> np.ndarray:
    ends = np.cumsum(sizes)
    heads = ends - sizes
    sa = np.full(len(s), -1, np.int64)
    sa[_places(order, s, ends)] = order
    seeds = np.bincount(s[order], minlength=len(sizes))
    fill = heads.copy()

    def push(wave: np.ndarray, want: bool, at: np.ndarray, direction: int) -> None:
        before = wave - 1
        before = before[before >= 0]
        before = before[small[before] == want]
        if not len(before):
            return
        chars = s[before]
        by = np.argsort(chars, kind="stable")
        before, chars = before[by], chars[by]
        new = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
        counts = np.diff(np.append(new, len(chars)))
        rank = np.arange(len(chars)) - np.repeat(new, counts)
        sa[at[chars] + (rank if direction > 0 else -1 - rank)] = before
        at[chars[new]] += direction * counts

    used = np.flatnonzero(sizes)
    for c in used.tolist():
        done = heads[c]
        while done < fill[c]:
            wave, done = sa[done : fill[c]], fill[c]
            push(wave, False, fill, 1)
        push(sa[ends[c] - seeds[c] : ends[c]], False, fill, 1)
    tail = ends.copy()
    for c in used[::-1].tolist():
        done = ends[c]
        while done > tail[c]:
            wave, done = sa[tail[c] : done][::-1], tail[c]
            push(wave, True, tail, -1)
        push(sa[heads[c] : fill[c]][::-1], True, tail, -1)
    sa[0] = len(s) - 1
    return sa


def _induce_one_by_one(s, small, order, sizes) -> np.ndarray:
    ends = np.cumsum(sizes)
    array = np.full(len(s), -1, np.int64)
    array[_places(order, s, ends)] = order
    sa = array.tolist()
    # The bucket of what stands to the left, where it is of the wanted type; the last is for places not filled yet.
    left = np.where(small[:-1], -1, s[:-1])
    bucket = [-1, *left.tolist(), -1]
    fill = (ends - sizes).tolist()
    # The lists grow while they are read: what is induced is met later in the same pass.
    for suffix in sa:
        c = bucket[suffix]
        if c >= 0:
            sa[fill[c]] = suffix - 1
            fill[c] += 1
    left = np.where(small[:-1], s[:-1], -1)
    bucket = [-1, *left.tolist(), -1]
    tail = ends.tolist()
    for suffix in reversed(sa):
        c = bucket[suffix]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = suffix - 1
    sa[0] = len(s) - 1
    return np.array(sa, np.int64)


def _named(s, rough, lms, length) -> tuple[np.ndarray, np.ndarray]:
    """(name, place) of the LMS substrings, in the order of a rough array: equal neighbours share a name."""
    n = len(s)
    size = np.zeros(n, np.int64)
    size[lms] = length
    order = rough[size[rough] > 0]
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    left, at = np.flatnonzero(same), 0
    while len(left):
        equal = s[np.minimum(a[left] + at, n - 1)] == s[np.minimum(b[left] + at, n - 1)]
        same[left[~equal]] = False
        at += 1
        left = left[equal]
        left = left[size[a[left]] > at]
    return np.concatenate([[0], np.cumsum(~same)]), order


def _refined(s, small, lms, length) -> tuple[np.ndarray, np.ndarray]:
    """(name, place) of the LMS substrings in their order, by one more character each time for those that are equal so far.

    Of equal characters an L is the smaller. Equal so far with types, substrings end together.
    """
    keys = 2 * s.astype(np.int64) + small
    most = int(keys.max()) + 1
    order, group = np.arange(len(lms)), np.zeros(len(lms), np.int64)
    left, at = np.arange(len(lms)), 0
    while len(left):
        items = order[left]
        both = group[left] * most + keys[lms[items] + at]
        by = np.argsort(both)
        order[left], both = items[by], both[by]
        new = np.concatenate([[True], both[1:] != both[:-1], [True]])
        # A group is named by the place of its first.
        first = left[np.flatnonzero(new[:-1])]
        group[left] = np.repeat(first, np.diff(np.flatnonzero(new)))
        at += 1
        left = left[~(new[:-1] & new[1:]) & (length[order[left]] > at)]
    return np.cumsum(group == np.arange(len(lms))) - 1, lms[order]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``s``, whole numbers of which the last is the smallest and unlike all others."""
    n = len(s)
    small = smaller_types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        return np.arange(n - 1, -1, -1) if n > 1 else np.zeros(n, np.int64)
    sizes = np.bincount(s)
    induce = _induce_by_waves if len(sizes) <= WAVES_MOST else _induce_one_by_one
    length = np.diff(np.append(lms, n - 1)) + 1
    if induce is _induce_by_waves:
        # Any order of the LMS suffixes inside their buckets sorts their substrings.
        rough = induce(s, small, lms[np.argsort(s[lms], kind="stable")], sizes)
        names, order = _named(s, rough, lms, length)
    else:
        names, order = _refined(s, small, lms, length)
    if names[-1] + 1 < len(lms):
        name_at = np.zeros(n, np.int64)
        name_at[order] = names
        order = lms[suffix_array(name_at[lms])]
    return induce(s, small, order, sizes)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place, how long its suffix and the one before it in the order agree (in order of places).

    Going one to the right takes at most one off. Where the characters to the left of both agree it takes exactly one;
    only the others are compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    known = (i > 0) & (before > 0)
    known[known] = s[i[known] - 1] == s[before[known] - 1]
    out = np.zeros(n, np.int64)
    left, size = np.flatnonzero(~known & (before >= 0)), 0
    while len(left):
        # The last, unlike all others, ends every comparison before either runs out.
        equal = s[np.minimum(left + size, n - 1)] == s[np.minimum(before[left] + size, n - 1)]
        out[left[~equal]] = size
        left, size = left[equal], size + 1
    fixed = np.maximum.accumulate(np.where(known, 0, i))
    return np.where(known, out[fixed] - (i - fixed), out)
