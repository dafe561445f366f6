"""Longest-previous-factor arrays of short strings, from a suffix array, up to a given length."""

from __future__ import annotations

import numpy as np


def prefix_ranks(text: np.ndarray, length: int) -> list[np.ndarray]:
    """Ranks of the prefixes of 1, 2, 4, ... symbols at each position, as far as ``length``. Symbols below zero are all
    different, and mark the ends of strings."""
    n = len(text)
    ends = text < 0
    symbols = np.where(ends, 0, text.astype(np.int64) + 1) + np.where(ends, 0, int(ends.sum()))
    symbols[ends] = np.arange(int(ends.sum()))
    levels = [np.unique(symbols, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while 2 * step <= length:
        rank = levels[-1].astype(np.int64)
        after = np.zeros(n, np.int64)
        after[:max(n - step, 0)] = rank[step:] + 1
        levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int32))
        step *= 2
    return levels


def common_prefix(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, ``length`` at most. Equal ranks never go past an end."""
    a, b, out, n = a.copy(), b.copy(), np.zeros(len(a), np.int64), len(levels[0])
    for level in range(len(levels) - 1, -1, -1):
        for _ in range(2 if level == len(levels) - 1 else 1):  # the highest power may fit twice
            same = (a < n) & (b < n) & (out < length)
            same[same] = levels[level][a[same]] == levels[level][b[same]]
            out += same * (1 << level)
            a, b = a + same * (1 << level), b + same * (1 << level)
    return np.minimum(out, length)


def suffix_order(levels: list[np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    """The given positions, ordered by their next ``length`` symbols (which must not go past an end)."""
    top = 1 << (len(levels) - 1)
    return at[np.lexsort((levels[-1][at + (length - top)], levels[-1][at]))]


def nearest_smaller(origin: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order, the common prefix with the nearest place before it that has a smaller origin.

    ``shared`` is the common prefix of a place and the one before. Every place jumps over those it has passed already, all at
    once, so the rounds are few; a place gives up when the common prefix falls below ``least`` (0 is returned).
    """
    before, reach = np.arange(len(origin)) - 1, shared.astype(np.int64).copy()
    reach[:1] = 0
    live = np.flatnonzero(reach >= least)
    live = live[origin[before[live]] >= origin[live]]
    while len(live):
        over = before[live]
        new_reach, new_before = np.minimum(reach[live], reach[over]), before[over]
        reach[live], before[live] = new_reach, new_before
        live = live[(new_reach >= least) & (new_before >= 0)]
        live = live[origin[before[live]] >= origin[live]]
    reach[(before < 0) | (reach < least)] = 0
    return reach


def factors(text: np.ndarray, at: np.ndarray, origin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in suffix order, with their longest previous and longest next factors: the longest prefix (``length`` at most,
    0 below it) that also starts at a smaller, or at a greater, origin. Of ``at`` each must have ``length`` symbols left."""
    levels = prefix_ranks(text, length)
    order = suffix_order(levels, at, length)
    rank = np.empty(len(text), np.int64)
    rank[at] = origin
    own = rank[order]
    shared = np.zeros(len(order), np.int64)
    shared[1:] = common_prefix(levels, order[1:], order[:-1], length)
    back = np.concatenate((shared[1:], [0]))[::-1] if len(shared) else shared
    previous = np.maximum(nearest_smaller(own, shared, length), nearest_smaller(own[::-1], back, length)[::-1])
    following = np.maximum(nearest_smaller(-own, shared, length), nearest_smaller(-own[::-1], back, length)[::-1])
    return order, previous, following
