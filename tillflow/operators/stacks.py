"""Stacks of units replayed on arrays: levels by a scan of clamp functions, matching by a sort of height ranges.

Rows come in segments (one stack each), in order. A push of q units raises the level, a void of q lowers it to no less
than 0, a stay of s lowers it to at most s. A unit has a place, its height; what is taken away is always on top.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

PUSH, VOID, STAY = 0, 1, 2


class Clamps(NamedTuple):
    """Functions ``level -> min(high, max(low, level + shift))``; what follows such a function is one again."""

    shift: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def after(self, level: np.ndarray | float) -> np.ndarray:
        return np.minimum(self.high, np.maximum(self.low, level + self.shift))


def clamps(op: np.ndarray, qty: np.ndarray, segment: np.ndarray, first: np.ndarray) -> Clamps:
    """For each row, what its segment's rows up to and with it do to the level at the segment's start.

    ``segment`` numbers the rows' segments, ``first`` is the first row of each. An associative scan: every step puts
    twice as many rows together, so a segment of n rows takes log2(n) steps.
    """
    shift = np.where(op == PUSH, qty, np.where(op == VOID, -qty, 0.0))
    low = np.zeros(len(op))
    high = np.where(op == STAY, qty, np.inf)
    place = np.arange(len(op)) - first[segment]
    rows, reach = np.flatnonzero(place), 1
    while len(rows):
        before = rows - reach
        s, lo, hi = shift[rows], low[rows], high[rows]
        shift[rows], low[rows], high[rows] = (
            shift[before] + s,
            np.minimum(hi, np.maximum(lo, low[before] + s)),
            np.minimum(hi, np.maximum(lo, high[before] + s)),
        )
        reach *= 2
        rows = rows[place[rows] >= reach]
    return Clamps(shift, low, high)


class _Least:
    """Smallest values of aligned runs of 1, 2, 4, ... entries, for finding the nearest smaller entry to the left."""

    def __init__(self, values: np.ndarray):
        self.size = 1 << max(1, int(len(values) - 1).bit_length())
        self.tree = np.full(2 * self.size, np.inf)
        self.tree[self.size : self.size + len(values)] = values
        level = self.size
        while level > 1:
            half = self.tree[level : 2 * level].reshape(-1, 2)
            self.tree[level // 2 : level] = half.min(axis=1)
            level //= 2

    def left(self, at: np.ndarray, below: np.ndarray) -> np.ndarray:
        """For each query the last entry before ``at`` that is smaller than ``below``; -1 if there is none."""
        out = np.full(len(at), -1)
        node, query = at + self.size, np.arange(len(at))
        found_node, found_query = [], []
        while len(node):
            right = (node & 1) == 1
            hit = np.zeros(len(node), bool)
            hit[right] = self.tree[node[right] - 1] < below[query[right]]
            found_node.append(node[hit] - 1)
            found_query.append(query[hit])
            node, query = node[~hit] >> 1, query[~hit]
            # On the left border of the tree nothing is left of it.
            on = (node & (node - 1)) != 0
            node, query = node[on], query[on]
        node, query = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (found_node, found_query))
        while True:
            inner = node < self.size
            if not inner.any():
                break
            child = 2 * node[inner] + 1
            node[inner] = np.where(self.tree[child] < below[query[inner]], child, child - 1)
        out[query] = node - self.size
        return out


class Pieces(NamedTuple):
    """Ranges of height, each pushed by one row and taken by one, or left."""

    push: np.ndarray  # the row that pushed it, -1 for what was there at the start
    take: np.ndarray  # the row that took it, -1 if it was left
    low: np.ndarray
    high: np.ndarray


def match(first: np.ndarray, push: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> Pieces:
    """Which units each row takes.

    A push puts units into the heights from ``low`` to ``high``, any other row takes what is there; rows follow each
    other without gaps, so that a push begins where the level stands and a take ends there. ``first`` is the first row
    of each segment, ``start`` the level before it; what was there then is taken under the number -1, and isn't listed
    if it is left.

    The range of a push is cut where a take ends inside of it: the push is the one that last raised the level past that
    height. A take is cut at the base of each push that it takes whole and more: for a push, it is the first row that
    leaves the level below its base. After that ranges are equal or apart, and sorted by height and row each range taken
    comes right after the same range pushed.
    """
    n, segments = len(low), len(first)
    if not n:
        none, nothing = np.zeros(0, np.int64), np.zeros(0)
        return Pieces(none, none, nothing, nothing)
    # A row before each segment pushes what is there at its start.
    size = np.diff(np.append(first, n))
    heads = first + np.arange(segments)
    row = np.full(n + segments, -1)
    is_row = np.ones(n + segments, bool)
    is_row[heads] = False
    row[is_row] = np.arange(n)
    rises, base, top = np.ones(n + segments, bool), np.zeros(n + segments), np.zeros(n + segments)
    rises[is_row], base[is_row], top[is_row], top[heads] = push, low, high, start
    segment = np.repeat(np.arange(segments), size + 1)
    level = np.where(rises, top, base)

    takes = np.flatnonzero(~rises & (base > 0))
    raised = np.maximum(_Least(level).left(takes, base[takes]), heads[segment[takes]] - 1) + 1
    raises = np.flatnonzero(rises & (base > 0))
    last = len(level) - 1
    lowered = last - _Least(level[::-1]).left(last - raises, base[raises])  # one past the end if there is none
    ends = (heads + size)[segment[raises]]
    found = lowered <= ends
    owner = np.concatenate([np.arange(len(level)), raised, lowered[found]])
    height = np.concatenate([base, base[takes], base[raises[found]]])
    inside = np.ones(len(owner), bool)
    inside[len(level) :] = (height[len(level) :] > base[owner[len(level) :]]) & (height[len(level) :] < top[owner[len(level) :]])
    owner, height = owner[inside], height[inside]
    order = np.lexsort((height, owner))
    owner, height = owner[order], height[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (height[1:] != height[:-1])
    owner, a = owner[new], height[new]
    b = top[owner]
    b[:-1] = np.where(owner[1:] == owner[:-1], a[1:], b[:-1])
    full = b > a
    owner, a, b = owner[full], a[full], b[full]

    order = np.lexsort((owner, a, segment[owner]))
    owner, a, b = owner[order], a[order], b[order]
    taken = np.flatnonzero(~rises[owner])
    given = taken - 1
    left = rises[owner]
    left[given] = False
    left &= row[owner] >= 0
    left = np.flatnonzero(left)
    none = np.full(len(left), -1)
    return Pieces(
        np.concatenate([row[owner[given]], row[owner[left]]]),
        np.concatenate([row[owner[taken]], none]),
        np.concatenate([a[taken], a[left]]),
        np.concatenate([b[taken], b[left]]),
    )


def replay(op: np.ndarray, qty: np.ndarray, segment: np.ndarray, first: np.ndarray, start: np.ndarray) -> tuple[Pieces, np.ndarray]:
    """Pieces of whole segments that start at the levels ``start``, and the levels at their ends."""
    after = clamps(op, qty, segment, first).after(start[segment])
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[first] = start
    ends = after[np.append(first[1:], len(op)) - 1]
    # Rows that change nothing have no range.
    moves = np.flatnonzero(after != before)
    low, high = np.minimum(before, after)[moves], np.maximum(before, after)[moves]
    held = segment[moves]
    begins = np.flatnonzero(np.diff(held, prepend=-1))
    found = match(begins, (after > before)[moves], low, high, start[held[begins]])
    back = np.append(moves, -1)  # -1 stays -1
    return Pieces(back[found.push], back[found.take], found.low, found.high), ends
