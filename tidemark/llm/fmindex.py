"""An FM-index over whole-number symbols: wavelet-tree ranks, backward search and sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by prefix doubling; a suffix that ends comes before its extensions."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - width, 0)] = rank[width:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        if n == 0 or new[order[-1]] == n:
            return order
        rank, width = new, width * 2


class WaveletTree:
    """Ranks of symbols in a sequence: a bit vector for each bit of the symbols, highest first, with running counts."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.zeros, self.counts = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            below = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - one, out=below[1:])
            self.counts.append(below)
            self.zeros.append(int(below[-1]))
            values = np.concatenate((values[one == 0], values[one == 1]))
        self.begin = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            below = self.counts[level][at]
            at = np.where((symbol >> b) & 1, self.zeros[level] + at - below, below)
        return at

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, before) - self.begin[symbol]


class FMIndex:
    """Finds sequences of symbols 1 and up in a text of such symbols."""

    SAMPLE = 8

    def __init__(self, text: np.ndarray, symbols: int):
        whole = np.append(text, 0)  # the end sorts first
        order = suffix_array(whole)
        self.last = whole[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(whole, minlength=symbols))))
        self.tree = WaveletTree(self.last, symbols)
        marked = order % self.SAMPLE == 0
        self.marked = marked
        self.samples = order[marked]
        self.ahead = np.concatenate(([0], np.cumsum(marked)))
        self.size = len(whole)

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For patterns of one length (rows), the suffixes that begin with each: from, to."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        for column in patterns.T[::-1]:
            low = self.first[column] + self.tree.rank(column, low)
            high = self.first[column] + self.tree.rank(column, high)
            high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back through the text to the next sampled one."""
        at, back = rows.copy(), np.zeros(len(rows), np.int64)
        todo = np.flatnonzero(~self.marked[at])
        while len(todo):
            symbol = self.last[at[todo]]
            at[todo] = self.first[symbol] + self.tree.rank(symbol, at[todo])
            back[todo] += 1
            todo = todo[~self.marked[at[todo]]]
        return self.samples[self.ahead[at]] + back
