"""FM-index over runs of integer symbols, in numpy: suffix array by prefix doubling, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Order of the suffixes of `ranks`; every end mark must be a rank of its own, so that no two suffixes are equal.

    Only suffixes that are still tied are sorted again when the compared length doubles.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    sorted_ranks = ranks[order]
    first = np.concatenate(([True], sorted_ranks[1:] != sorted_ranks[:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    rank[order] = starts
    length = 1
    while True:
        single = first & np.concatenate((first[1:], [True])) if n else first
        slots = np.flatnonzero(~single)
        if not len(slots):
            return order
        tied = order[slots]
        key = rank[tied] * n + rank[tied + length]
        by_key = np.argsort(key, kind="stable")
        tied, key = tied[by_key], key[by_key]
        order[slots] = tied
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first[slots] = new
        rank[tied] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        length *= 2


class Wavelet:
    """Wavelet matrix: one level of prefix counts for each bit of a symbol, highest bit first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.shifts = range(max(1, int(sigma).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        level = symbols
        for shift in self.shifts:
            bit = (level >> shift) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            up = bit.astype(bool)
            self.zeros.append(int(len(level) - self.ones[-1][-1]))
            level = np.concatenate((level[~up], level[up]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its end."""
        start, end = np.zeros(len(ends), np.int64), ends.astype(np.int64)
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros):
            up = ((symbols >> shift) & 1).astype(bool)
            a, b = ones[start], ones[end]
            start, end = np.where(up, zeros + a, start - a), np.where(up, zeros + b, end - b)
        return end - start


class FMIndex:
    """Index of `symbols` (1 to sigma), in which 0 ends each run; the last symbol must be 0."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE):
        symbols = symbols.astype(np.int64)
        n, ends = len(symbols), symbols == 0
        marks = int(ends.sum())
        order = suffix_array(np.where(ends, np.cumsum(ends) - 1, symbols + marks))
        self.before = symbols[order - 1]
        self.tree = Wavelet(self.before, sigma)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=sigma + 1))))
        known = (order % sample == 0) | (self.before == 0)
        self.known, self.slot, self.places = known, np.cumsum(known) - 1, order[known]
        self.n = n

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of right-aligned patterns by backward search; empty where a pattern does not occur."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            c = patterns[live, -back]
            low[live] = self.starts[c] + self.tree.rank(c, low[live])
            high[live] = self.starts[c] + self.tree.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a row whose position was kept."""
        rows, found = rows.copy(), np.zeros(len(rows), np.int64)
        steps, open_ = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            ready = self.known[at]
            done = open_[ready]
            found[done] = self.places[self.slot[at[ready]]] + steps[done]
            open_, at = open_[~ready], at[~ready]
            c = self.before[at]
            rows[open_] = self.starts[c] + self.tree.rank(c, at)
            steps[open_] += 1
        return found
