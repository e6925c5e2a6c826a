"""An FM-index over word numbers: how often and where phrases occur."""

from __future__ import annotations

import numpy as np


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``s``, by prefix doubling; only ties are sorted again."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = s[order][1:] != s[order][:-1]
    group = np.flatnonzero(new)[np.cumsum(new) - 1]  # rank: the first place of the group
    rank[order] = group
    step = 1
    while True:
        size = np.diff(np.append(np.flatnonzero(new), n))
        tied = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(tied):
            return order
        at = order[tied]
        after = at + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[at]
        by = np.lexsort((second, first))
        order[tied] = at[by]
        first, second = first[by], second[by]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        new[tied] = fresh
        group = np.flatnonzero(new)[np.cumsum(new) - 1]
        rank[order[tied]] = group[tied]
        step *= 2


class WaveletTree:
    """How often a number occurs before a place of a sequence, in one bit vector for each bit of the numbers."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        values = values.astype(np.int64)
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit) & 1
            zeros_before = np.concatenate([[0], np.cumsum(1 - ones)])
            self.levels.append((zeros_before, int(zeros_before[-1]), ones.astype(np.uint8)))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each ``value`` among the first ``place`` numbers."""
        low, high = np.zeros_like(place), place.copy()
        for level, (zeros_before, zeros, _) in enumerate(self.levels):
            one = ((value >> (self.bits - 1 - level)) & 1).astype(bool)
            low = np.where(one, zeros + low - zeros_before[low], zeros_before[low])
            high = np.where(one, zeros + high - zeros_before[high], zeros_before[high])
        return high - low

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number at each place, and how often it occurs before."""
        value, low, at = np.zeros_like(place), np.zeros_like(place), place.copy()
        for zeros_before, zeros, ones in self.levels:
            one = ones[at].astype(bool)
            value = value * 2 + one
            low = np.where(one, zeros + low - zeros_before[low], zeros_before[low])
            at = np.where(one, zeros + at - zeros_before[at], zeros_before[at])
        return value, at - low


class FMIndex:
    """Counts and finds phrases in a sequence of numbers from 1; 0 ends the sequence."""

    def __init__(self, sequence: np.ndarray, largest: int, sample: int = 8):
        s = np.append(sequence, 0).astype(np.int64)
        order = suffix_array(s)
        self.n = len(s)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=largest + 1))])
        self.last = WaveletTree(s[order - 1], max(1, int(largest).bit_length()))
        self.sampled = order % sample == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.positions = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, rows of numbers padded on the left; all are searched at once, backwards."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1]):
            live = np.flatnonzero((k < lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, -1 - k]
            low[live] = self.below[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.last.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to the next sampled one."""
        out, at = np.empty(len(rows), np.int64), rows.copy()
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            here = at[walking]
            done = self.sampled[here]
            out[walking[done]] = self.positions[self.sampled_before[here[done]]] + steps
            walking = walking[~done]
            symbol, before = self.last.access(at[walking])
            at[walking] = self.below[symbol] + before
            steps += 1
        return out
