"""A run-length index of a set of strings: run-compressed Burrows-Wheeler transform with suffix-array samples at run ends.

With ``before(i)`` the suffix just ahead of suffix i in sorted order and ``length(i)`` how many bytes the two have in common:
where the transform does not begin a run at suffix i, ``before(i) = before(i - 1) + 1`` and ``length(i) = length(i - 1) - 1``.
So the samples at run starts, held with the ends of the runs ahead of them, give both for every position: a scan in text
order streams the matching statistics, each sample's length falling by one a byte until the next sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


_FIRST = 7  # bytes in the first sort key, nine bits each


@dataclass
class RunIndex:
    n: int  # bytes of all strings with their terminators
    heads: np.ndarray  # byte of each run of the transform; 0 for a terminator
    starts: np.ndarray  # row at which each run begins
    at: np.ndarray  # suffixes at run starts, in text order
    before: np.ndarray  # the suffix at the end of the run ahead of each
    length: np.ndarray  # bytes that the two share, ``least`` and what lies above alike counted whole

    def matches(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions i whose suffix shares ``least`` bytes or more with the one ahead of it, and those suffixes.

        Streams the statistics over the text from the samples, skipping samples whose length is too small.
        """
        span = np.diff(np.r_[self.at, self.n])
        many = np.clip(np.minimum(self.length - least + 1, span), 0, None)
        total = int(many.sum())
        step = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(self.at, many) + step, np.repeat(self.before, many) + step


def suffix_array(text: np.ndarray, ends: np.ndarray, order_of: np.ndarray) -> np.ndarray:
    """Suffixes of strings in sorted order by prefix doubling; a string ends below any byte, earlier strings first.

    ``ends``: for each position the number of bytes to its string's terminator; ``order_of``: each position's string.
    """
    n = len(text)
    padded = np.r_[text.astype(np.int64) + 1, np.zeros(_FIRST, np.int64)]
    key = np.zeros(n, np.int64)
    for k in range(_FIRST):
        key = key << 9 | np.where(ends > k, padded[k : k + n], 0)
    order = np.argsort(key)
    rows = np.arange(n)
    rank = np.empty(n, np.int64)  # the first row of those that are equal so far
    rank[order] = np.maximum.accumulate(np.where(np.r_[True, key[order][1:] != key[order][:-1]], rows, 0))
    open_, h = rows, _FIRST
    while True:
        open_ = open_[np.bincount(rank, minlength=n)[rank[open_]] > 1]
        if not len(open_):
            return order
        # a suffix of fewer than h bytes equals only others of its length, which stand in the order of their strings
        later = np.where(ends[open_] >= h, rank[np.minimum(open_ + h, n - 1)], order_of[open_])
        both = rank[open_] * n + later
        turn = np.argsort(both)
        open_, both, at = open_[turn], both[turn], np.arange(len(open_))
        old = rank[open_]
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        fresh = np.maximum.accumulate(np.where(np.r_[True, both[1:] != both[:-1]], at, 0))
        order[old + at - group] = open_
        rank[open_] = old + fresh - group
        h *= 2


def common_length(text: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes a and b share within their strings."""
    most = np.minimum(ends[a], ends[b])
    same = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        at = same[live]
        equal = text[a[live] + at] == text[b[live] + at]
        live = live[equal]
        same[live] += 1
        live = live[same[live] < most[live]]
    return same


def build(strings: list[bytes]) -> tuple[RunIndex, np.ndarray]:
    """The index of ``strings`` and each string's first position."""
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    starts = np.cumsum(np.r_[0, lengths + 1])
    text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    number = np.repeat(np.arange(len(strings)), lengths + 1)
    ends = starts[number] + lengths[number] - np.arange(len(text))
    order = suffix_array(text, ends, number)
    ahead = np.where(order == starts[number[order]], -1, text[order - 1].astype(np.int64))
    change = np.r_[True, (ahead[1:] != ahead[:-1]) | (ahead[1:] == -1)]
    rows = np.flatnonzero(change)
    at, before = order[rows], order[np.maximum(rows - 1, 0)]
    length = common_length(text, ends, at, before)
    length[rows == 0] = 0
    by_text = np.argsort(at)
    index = RunIndex(len(text), np.maximum(ahead[rows], 0).astype(np.uint8), rows, at[by_text], before[by_text], length[by_text])
    return index, starts[:-1]


def least_over_matches(index: RunIndex, least: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position whose ``least``-byte string occurs elsewhere, the least of ``values`` over all its occurrences.

    Equal strings are one stretch of suffixes, a chain of ``before``; the minimum spreads along it by pointer doubling.
    """
    i, j = index.matches(least)
    if not len(i):
        return i, values[i]
    nodes = np.unique(np.r_[i, j])
    up = np.arange(len(nodes))
    at_i, at_j = np.searchsorted(nodes, i), np.searchsorted(nodes, j)
    up[at_i] = at_j
    low = values[nodes].copy()
    while True:  # towards the head of each chain
        low = np.minimum(low, low[up])
        further = up[up]
        if (further == up).all():
            break
        up = further
    # the head takes the minimum of all its chain, and gives it to all
    head = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(head, up, low)
    return nodes, head[up]
