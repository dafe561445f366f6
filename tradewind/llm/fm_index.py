"""FM-index over a sequence of small integers: backward search by wavelet-matrix ranks, location by sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. Zeros separate strings: each is a symbol of its own, ordered by place and below all
    others, so that no comparison goes beyond a string's end."""
    n = len(text)
    separator = text == 0
    rank = np.where(separator, np.cumsum(separator) - 1, text.astype(np.int64) + int(separator.sum()))
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_rank[1:] != sorted_rank[:-1]))) if n else []
        if n == 0 or new.max() == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:max(n - step, 0)] = new[step:] + 1
        rank = new * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


class WaveletMatrix:
    """Counts of a symbol in any prefix, for many symbols and prefixes at once."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.ones, self.zeros = [], []
        self.bits = list(range(max(int(symbols - 1).bit_length(), 1) - 1, -1, -1))
        for bit in self.bits:
            one = (values >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(one, dtype=np.int32))))
            self.zeros.append(len(values) - int(one.sum()))
            values = np.concatenate((values[one == 0], values[one == 1]))

    def rank(self, symbol: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        at, start = prefix.astype(np.int64), np.zeros(len(prefix), np.int64)
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros):
            right = ((symbol >> bit) & 1).astype(bool)
            at = np.where(right, zeros + ones[at], at - ones[at])
            start = np.where(right, zeros + ones[start], start - ones[start])
        return at - start


class FMIndex:
    """Index of strings over symbols 1 and up, each ended by a zero."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        order = suffix_order(text)
        self.last = text[order - 1].astype(np.int64)  # the symbol before each suffix; that of the first is the closing zero
        self.ranks = WaveletMatrix(self.last, symbols)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        # Positions are kept for every `sample`-th suffix and for each string's start, where the walk back would leave it.
        self.sampled = (order % sample == 0) | (self.last == 0)
        self.position, self.before = order[self.sampled], np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that start with each phrase (a row, left-aligned)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.last), np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((step < lengths) & (low < high))
            symbol = phrases[live, lengths[live] - 1 - step]
            low[live] = self.below[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix, by walking back to a sampled one."""
        rows, out, steps = rows.copy(), np.empty(len(rows), np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.position[self.before[rows[done]]] + steps
            rows, left = rows[~done], left[~done]
            symbol = self.last[rows]
            rows = self.below[symbol] + self.ranks.rank(symbol, rows)
            steps += 1
        return out
