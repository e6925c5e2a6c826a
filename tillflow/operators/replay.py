"""Replaying the order log of bills that were split.

The lines ordered on the first bill of a family (the root) form a stock per item. Later
log rows take from it, always the units ordered last:

* a void of q units lowers the stock to ``max(0, stock - q)``;
* a split event names, per item, the quantity ``s`` that stays. The stock goes down to
  ``min(stock, s)`` and what leaves goes to the child bill. Items not named stay with 0.

So items do not affect each other, and a unit's fate depends only on its height in the
stock of its (root, item) and on the stock levels after it. The rows are range-partitioned
by (root, item) and order, and every block of rows is replayed on arrays (``stacks``):

1. groups that begin in a block start at level 0. The first group of a block may go on from
   the block before, so its rows wait; what they do to any level is one clamp function;
2. those functions, one or two for each block, give the levels at which the waiting rows
   start, and they are replayed from there. What reaches below what the block itself
   ordered, and what a block leaves, remain as height ranges;
3. for groups that lie in several blocks, those ranges are handed out by height and
   matched there, in block order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.operators.groups import lookup, order_key
from tillflow.operators.ordered import PARTS, in_parts
from tillflow.operators.scan import BROADCAST_EDGES, PART, Fill, First, Groups, blocks, in_order, scan, whole_groups
from tillflow.operators.stacks import PUSH, STAY, VOID, Pieces, clamps, match, replay
from tillflow.options import CHANGE, SPLIT, GroupLimits
from tillflow.session import written

EVENT = ["root", "time", "child_id", "child_no"]

# What a replay hands on: LEFT units are still in stock, TAKEN ones went to a child bill, DEEP takings reach below the
# stock the block itself built up. WAITING rows are to be replayed, and an EDGE is what a block does to a group's level.
LEFT, TAKEN, DEEP, WAITING, EDGE = range(5)

_FIELDS = {
    "root": pa.string(), "item": pa.string(), PART: pa.int64(), "piece": pa.int32(), "low": pa.float64(), "high": pa.float64(),
    "seq": pa.int64(), "line_no": pa.int32(), "event_seq": pa.int64(), "event_line": pa.int32(), "stays": pa.bool_(),
    "op": pa.int32(), "qty": pa.float64(), "place": pa.int64(), "shift": pa.float64(),
}
_DDL = {pa.string(): "string", pa.int64(): "bigint", pa.int32(): "int", pa.float64(): "double", pa.bool_(): "boolean"}
PIECES = ", ".join(f"{name} {_DDL[kind]}" for name, kind in _FIELDS.items())


def _out(n: int, **columns) -> pa.RecordBatch:
    """Rows of the common schema; a column that isn't given is null."""
    arrays = []
    for name, kind in _FIELDS.items():
        values = columns.get(name)
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        elif values is not None and not isinstance(values, pa.Array):
            values = pa.array(np.broadcast_to(values, n))
        arrays.append(pa.nulls(n, kind) if values is None else values.cast(kind))
    return pa.RecordBatch.from_arrays(arrays, list(_FIELDS))


def _at(rows: np.ndarray) -> pa.Array:
    return pa.array(rows, mask=rows < 0)


def _found(table: pa.Table, pieces: Pieces, split: np.ndarray, lines: tuple[str, str], events: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """What is left, what went to child bills, and what reached below; ``split`` tells splits from voids among rows."""
    takes = pieces.take >= 0
    stays = takes & split[np.maximum(pieces.take, 0)]
    kind = np.where(~takes, LEFT, np.where(pieces.push >= 0, TAKEN, DEEP))
    kept = np.flatnonzero((kind != TAKEN) | stays)
    push, take = pieces.push[kept], pieces.take[kept]
    some = np.where(push >= 0, push, take)
    of = lambda name, at: table.column(name).take(_at(at))
    yield _out(
        len(kept),
        root=of("root", some), item=of("item", some), piece=kind[kept], low=pieces.low[kept], high=pieces.high[kept],
        seq=of(lines[0], push), line_no=of(lines[1], push), event_seq=of(events[0], take), event_line=of(events[1], take),
        stays=stays[kept], **({PART: of(PART, some)} if PART in table.column_names else {}),
    )


def _values(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(name).to_numpy() for name in names]


LINE = ("seq", "line_no")


def _replay_blocks(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, block in blocks(batches, most):
        groups = Groups(block, ["root", "item"])
        block = block.append_column(PART, pa.array(np.full(groups.n, number)))
        op, qty = _values(block, "op", "qty")
        n = int(groups.size[0])
        waiting = block.slice(0, n)
        yield _out(n, piece=WAITING, place=np.arange(n), **{c: waiting.column(c) for c in ("root", "item", PART, *LINE, "op", "qty")})
        one = np.zeros(n, np.int64)
        whole = clamps(op[:n], qty[:n], one, one[:1])
        yield _edge(block, 0, whole.shift[-1], whole.low[-1], whole.high[-1])
        if n < groups.n:
            first = groups.first[1:] - n
            pieces, ends = replay(op[n:], qty[n:], groups.group[n:] - 1, first, np.zeros(len(first)))
            rest = block.slice(n)
            yield from _found(rest, pieces, op[n:] == STAY, LINE, LINE)
            # It begins here, so the level at its end is known.
            yield _edge(block, groups.n - 1, 0.0, ends[-1], ends[-1])


def _edge(block: pa.Table, row: int, shift: float, low: float, high: float) -> pa.RecordBatch:
    at = block.slice(row, 1)
    return _out(1, piece=EDGE, shift=shift, low=low, high=high, **{c: at.column(c) for c in ("root", "item", PART)})


def _replay_waiting(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups at the beginnings of blocks, from the levels ``start``."""
    for table in whole_groups(batches, [PART], most):
        groups = Groups(table, [PART])
        op, qty, start = _values(table, "op", "qty", "start")
        pieces, _ = replay(op, qty, groups.group, groups.first, start[groups.first])
        yield from _found(table, pieces, op == STAY, LINE, LINE)


def _match_ranges_of(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What blocks left over within ranges of heights, in block order."""
    keys = ["root", "item", "_range"]
    for table in whole_groups(batches, keys, most):
        groups = Groups(table, keys)
        piece, low, high, stays = _values(table, "piece", "low", "high", "stays")
        pieces = match(groups.first, piece == LEFT, low, high, np.zeros(len(groups.first)))
        yield from _found(table, pieces, stays, LINE, ("event_seq", "event_line"))


def _in_family(lines: DataFrame, position: list[str], limits: GroupLimits) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Log rows that know whether they are the root's, split events, and the units that stay by event and item.

    A row and an event know the next event of the family (``_next``). All this comes from one scan of the family's rows,
    in which the events stand before the first of their log rows.
    """
    rest = [c for c in position if c not in EVENT]
    first = F.min_by(F.struct(*rest), order_key(position)).alias("_at")
    splits = lines.where((F.col("log_type") == SPLIT) & F.col("child_id").isNotNull() & F.col("child_no").isNotNull())
    # Read by several steps below.
    per_item = written(splits.groupBy(*EVENT, "item").agg(F.sum("qty").alias("qty"), first).select(*EVENT, "item", "qty", "_at.*"))
    first = F.min_by(F.struct(*rest), order_key(position)).alias("_at")
    events = per_item.groupBy(*EVENT).agg(first).select(*EVENT, "_at.*")
    event = F.struct("child_id", "child_no", *[F.col(c).alias(f"_e_{c}") for c in position])

    # The bill that stands for the root: the first one named like it, else the first of all.
    named_like = F.contains(F.col("id"), F.col("root"))
    rows = lines.withColumns(
        {"_kind": F.lit(1), "_named": F.when(named_like, F.col("id")), "_any": F.struct("id")}
    ).unionByName(events.select("root", *position, F.lit(0).alias("_kind"), event.alias("_event")), allowMissingColumns=True)
    wanted = [First("_named", "_named"), First("_any", "_any"), Fill("_event", "_next", forward=False, own=False)]
    rows = scan(rows, ["root"], [*position, "_kind"], wanted, limits)
    is_root = F.coalesce(F.col("id") == F.coalesce("_named", "_any.id"), F.lit(False))
    own = rows.where(F.col("_kind") == 1).select(*lines.columns, is_root.alias("is_root"), "_next")
    events = rows.where(F.col("_kind") == 0).select("root", *position, "_event.child_id", "_event.child_no", "_next")
    return own, events, per_item


def _stock_moves(own: DataFrame, events: DataFrame, per_item: DataFrame, position: list[str], limits: GroupLimits) -> DataFrame:
    """Pushes, voids and splits of every (root, item) in family order."""
    own = own.where((F.col("log_type") == CHANGE) & F.col("is_root"))
    # An event that does not name an item still clears it. Only the first event after a
    # line, or after an event that let some units stay, can find stock to clear.
    named = lookup(per_item.where(F.col("item").isNotNull()).select(*EVENT, "item", "qty"), events, EVENT, "inner", limits)
    here = ["root", "item", *position]
    may_stay = own.where(F.col("qty") > 0).select("root", "item", "_next").unionByName(named.select("root", "item", "_next"))
    cleared = may_stay.where(F.col("_next").isNotNull()).select(
        "root",
        "item",
        "_next.child_id",
        "_next.child_no",
        *[F.col(f"_next._e_{c}").alias(c) for c in position],
        F.lit(0.0).alias("qty"),
    )
    stays = (
        named.select(*cleared.columns)
        .unionByName(cleared)
        .groupBy(*here, "child_id", "child_no")
        .agg(F.abs(in_parts(F.sum("qty"))).alias("qty"))
    )
    moves = own.select(
        *here,
        F.when(F.col("qty") > 0, PUSH).otherwise(VOID).alias("op"),
        F.abs(in_parts(F.col("qty"))).alias("qty"),
    ).unionByName(stays.select(*here, F.lit(STAY).alias("op"), "qty"))
    # Computed once: finding the ranges reads the rows before they are dealt out.
    return written(moves)


def _starts(edges: DataFrame) -> DataFrame:
    """The stock level at the start of every block of the groups at the edges of blocks, and in how many blocks they lie.

    Two rows per block come in, so a group's blocks fit an array: their number is bounded by the limits on blocks.
    """
    steps = F.array_sort(F.collect_list(F.struct(PART, "shift", "low", "high")))
    zero = F.struct(F.lit(0.0).alias("level"), F.array().cast("array<struct<part:bigint,start:double>>").alias("starts"))

    def step(acc: Column, b: Column) -> Column:
        level = F.least(b["high"], F.greatest(b["low"], acc["level"] + b["shift"]))
        seen = F.struct(b[PART].alias("part"), acc["level"].alias("start"))
        return F.struct(level.alias("level"), F.concat(acc["starts"], F.array(seen)).alias("starts"))

    groups = edges.groupBy("root", "item").agg(F.aggregate(steps, zero, step)["starts"].alias("_starts"))
    each = groups.select(F.col("root").alias("_root"), F.col("item").alias("_item"), F.explode("_starts").alias("_s"), F.size("_starts").alias("_blocks"))
    return each.select("_root", "_item", F.col("_s.part").alias("_in"), F.col("_s.start").alias("start"), "_blocks")


def _same_group() -> Column:
    return (F.col("root") == F.col("_root")) & F.col("item").eqNullSafe(F.col("_item"))


def _match_ranges(pieces: DataFrame, limits: GroupLimits) -> DataFrame:
    """Step 3: match left-over units with later deep takings, by ranges of height.

    Ranges have a fixed width per group. In a block the left-over pieces of a kind do not
    overlap, so a range takes from each block pieces of at most its own width.
    """
    sizes = pieces.groupBy(F.col("root").alias("_root"), F.col("item").alias("_item")).agg(F.count("*").alias("n"), F.max("high").alias("top"))
    # Powers of two, so that dividing by the width is exact.
    width = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("top") * limits.max_rows / F.col("n"))))
    widths = sizes.where(F.col("n") > limits.max_rows).select("_root", "_item", width.alias("_width"))
    low, high, width = F.col("low"), F.col("high"), F.col("_width")
    spans = F.sequence(F.floor(low / width), F.greatest(F.ceil(high / width) - 1, F.floor(low / width)))
    floor = F.col("_range") * width
    parts = (
        pieces.join(widths, _same_group(), "left")
        .withColumn("_range", F.explode(F.when(width.isNotNull(), spans).otherwise(F.array(F.lit(0).cast("bigint")))))
        .withColumns({"low": F.greatest(low, floor), "high": F.least(high, floor + width)})
        .where(F.col("high") > F.col("low"))
    )
    # In a block the takings come first, from high to low, then its own units, low to high.
    walk = [F.col(PART), F.desc("piece"), F.when(F.col("piece") == DEEP, -F.col("low")).otherwise(F.col("low"))]
    keys = ["root", "item", "_range"]
    parts = parts.repartition(*keys).sortWithinPartitions(*keys, *walk)
    cols = ["piece", "low", "high", "seq", "line_no", "event_seq", "event_line", "stays"]
    matched = parts.select(*keys, *cols).mapInArrow(lambda batches: _match_ranges_of(limits.max_rows, batches), PIECES)
    # A line's units that one event takes may lie in several ranges.
    line = ["piece", "seq", "line_no", "event_seq", "event_line"]
    return matched.where(F.col("piece") != DEEP).groupBy(*line).agg(F.sum(F.col("high") - F.col("low")).alias("units"))


def _replayed(moves: DataFrame, walk: list[str], limits: GroupLimits) -> DataFrame:
    """Units by line and event: ``piece, seq, line_no, event_seq, event_line, units``."""
    most, seen = limits.max_rows, Observation()
    rows = in_order(moves, ["root", "item"], walk).select("root", "item", "op", "qty", *LINE)
    found = rows.mapInArrow(lambda batches: _replay_blocks(most, batches), PIECES)
    found = written(found.observe(seen, F.count_if(F.col("piece") == EDGE).alias("edges")))
    starts = _starts(found.where(F.col("piece") == EDGE))
    cut = starts.where(F.col("_blocks") > 1).select("_root", "_item", F.lit(True).alias("_cut")).distinct()
    if seen.get["edges"] <= BROADCAST_EDGES:
        starts, cut = F.broadcast(starts), F.broadcast(cut)
    waiting = found.where(F.col("piece") == WAITING).join(starts, (F.col(PART) == F.col("_in")) & _same_group())
    waiting = waiting.repartition(PART).sortWithinPartitions(PART, "place").select("root", "item", PART, "op", "qty", *LINE, "start")
    late = waiting.mapInArrow(lambda batches: _replay_waiting(most, batches), PIECES)
    pieces = found.where(F.col("piece") < WAITING).unionByName(late).join(cut, _same_group(), "left")
    is_open = (F.col("piece") != TAKEN) & F.col("_cut").isNotNull()
    line = ["piece", "seq", "line_no", "event_seq", "event_line"]
    # Below a group that lies in one block there is nothing.
    settled = pieces.where(~is_open & (F.col("piece") != DEEP)).select(*line, (F.col("high") - F.col("low")).alias("units"))
    return settled.unionByName(_match_ranges(pieces.where(is_open).drop("_root", "_item", "_cut"), limits))


def replay_splits(lines: DataFrame, order: list[str], limits: GroupLimits | None = None) -> DataFrame:
    """Who finally has which units of the lines of split families.

    ``lines`` has root, id, number, log_type, item, qty, child_id, child_no, time, seq and
    line_no, unique together; other columns travel along. ``order`` orders the rows of a
    family. Returns the surviving lines with ``id``, ``number`` and ``qty`` replaced, and
    with the place of the log row that put them there (``emit`` and ``at_end``), because
    the order of results decides ties later on.
    """
    limits = limits or GroupLimits()
    position = [*order, "seq", "line_no"]
    own, events, per_item = _in_family(lines.where(F.col("root").isNotNull()), position, limits)
    moves = _stock_moves(own, events, per_item, position, limits)
    pieces = _replayed(moves, [*position, "op"], limits)
    return _results(own.drop("_next"), pieces, events.drop("_next"), position, limits)


def _results(
    lines: DataFrame, pieces: DataFrame, events: DataFrame, position: list[str], limits: GroupLimits
) -> DataFrame:
    place = lambda: F.struct(*position)
    lines = lines.where(F.col("log_type") == CHANGE).withColumn("line_at", place())
    passed_on = lines.where(~F.col("is_root")).withColumns({"emit": place(), "at_end": F.lit(0)})
    ordered = lines.where("is_root").withColumnsRenamed({"seq": "_seq", "line_no": "_line"}).drop("qty")
    events = events.select(
        F.col("seq").alias("event_seq"),
        F.col("line_no").alias("event_line"),
        F.col("child_id").alias("_to_id"),
        F.col("child_no").alias("_to_number"),
        place().alias("emit"),
    )
    taken = F.col("piece") == TAKEN
    # What is left has no event.
    went = lookup(pieces.where(taken), events, ["event_seq", "event_line"], "left", limits, nulls_match=False)
    pieces = went.unionByName(pieces.where(~taken), allowMissingColumns=True).withColumn("qty", F.col("units") / PARTS)
    pieces = pieces.join(ordered, (F.col("seq") == F.col("_seq")) & (F.col("line_no") == F.col("_line")))
    pieces = pieces.withColumns(
        {
            "id": F.when(taken, F.col("_to_id")).otherwise(F.col("id")),
            "number": F.when(taken, F.col("_to_number")).otherwise(F.col("number")),
            "at_end": F.when(taken, 0).otherwise(1),
        }
    )
    out = [c for c in passed_on.columns if c not in ("is_root", "child_id", "child_no")]
    return passed_on.select(*out).unionByName(pieces.select(*out))
