"""Stacks replayed on arrays, against a loop with a list for each stack."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tillflow.operators import scan, stacks
from tillflow.operators.stacks import PUSH, STAY, VOID


def loop(rows, start):
    """Pieces (pushed by, taken by, low, high) and the level at the end; -1 is what was there, or nobody."""
    stock = [(0.0, start, -1)] if start else []
    out, level = [], start
    for i, (op, q) in enumerate(rows):
        if op == PUSH:
            if q:
                stock.append((level, level + q, i))
                level += q
            continue
        target = max(0.0, level - q) if op == VOID else min(level, q)
        while level > target:
            low, high, line = stock.pop()
            if low < target:
                stock.append((low, target, line))
                low = target
            out.append((line, i, low, high))
            level = low
    return out + [(line, -1, low, high) for low, high, line in stock if line >= 0], level


def arrays(segments):
    op = np.array([o for s in segments for o, _ in s])
    qty = np.array([q for s in segments for _, q in s], float)
    size = [len(s) for s in segments]
    return op, qty, np.repeat(np.arange(len(size)), size), np.cumsum([0, *size[:-1]])


@pytest.mark.parametrize("seed", range(8))
def test_replay(seed):
    rng = random.Random(seed)
    for _ in range(60):
        segments = [
            [(rng.choice([PUSH, PUSH, PUSH, VOID, VOID, STAY]), rng.randrange(6)) for _ in range(rng.choice([1, 1, 2, 3, 8, 40]))]
            for _ in range(rng.randrange(1, 6))
        ]
        start = np.array([float(rng.choice([0, 0, 3, 10])) for _ in segments])
        op, qty, segment, first = arrays(segments)
        found, ends = stacks.replay(op, qty, segment, first, start)
        want = []
        for rows, at, level, end in zip(segments, first.tolist(), start.tolist(), ends.tolist(), strict=True):
            pieces, last = loop(rows, level)
            assert last == end
            want += [(a + at if a >= 0 else -1, b + at if b >= 0 else -1, low, high) for a, b, low, high in pieces]
        assert sorted(zip(*(x.tolist() for x in found), strict=True)) == sorted(want)


def test_rows_of_a_segment_compose():
    rng = random.Random(4)
    segments = [[(rng.randrange(3), rng.randrange(9)) for _ in range(n)] for n in (1, 2, 3, 7, 64, 65)]
    op, qty, segment, first = arrays(segments)
    whole = stacks.clamps(op, qty, segment, first)
    for level in (0.0, 4.0, 100.0):
        after = whole.after(level)
        for rows, at in zip(segments, first.tolist(), strict=True):
            now = level
            for i, (o, q) in enumerate(rows):
                now = now + q if o == PUSH else max(0.0, now - q) if o == VOID else min(now, q)
                assert after[at + i] == now


def test_pieces_do_not_multiply():
    # All pushed, then all taken, at heights that never agree: at most a piece for each row and each border.
    n = 20_000
    op = np.repeat([PUSH, VOID], n)
    qty = np.concatenate([np.full(n, 7.0), np.full(n, 5.0)])
    found, ends = stacks.replay(op, qty, np.zeros(2 * n, int), np.zeros(1, int), np.zeros(1))
    assert len(found.low) <= 4 * n and ends[0] == 2.0 * n
    assert (found.high - found.low)[found.take < 0].sum() == 2 * n


def test_nothing():
    none = np.zeros(0, np.int64)
    assert len(stacks.match(none, none.astype(bool), none.astype(float), none.astype(float), none.astype(float)).low) == 0
    found, ends = stacks.replay(np.array([VOID]), np.array([3.0]), np.zeros(1, int), np.zeros(1, int), np.zeros(1))
    assert len(found.low) == 0 and ends.tolist() == [0.0]


@pytest.mark.parametrize("most", [1, 3, 10, 1000])
def test_whole_groups(most):
    keys = [k for k, n in [("a", 1), (None, 4), ("b", 2), ("c", 17), ("d", 1)] for _ in range(n)]
    batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[i : i + 3], pa.string())}) for i in range(0, len(keys), 3)]
    tables = [t.column("k").to_pylist() for t in scan.whole_groups(iter(batches), ["k"], most)]
    assert [k for t in tables for k in t] == keys
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:], strict=False))
