"""Shards of nearly equal size: the smallest capacity that contiguous groups of equal texts can be cut into."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import written

#: Most intervals of the cumulative size that the driver holds at once.
INTERVALS = 1 << 16


def _least_capacity(total: int, shards: int, refine: Callable[[list[tuple[int, int]], int], np.ndarray]) -> list[int]:
    """Cumulative sizes after which to cut, for the smallest capacity that ``shards`` cuts can keep.

    ``refine(ranges, width)`` looks at the group ends within the ranges, in steps of ``width``, and returns the
    first and the last end of every step that has one, as rows of an array in order. A search over capacities packs
    greedily on those intervals: to the first end for a pessimistic answer, to the end that would be best for an
    optimistic one. Where the two differ, the intervals that they touched are looked at more closely.
    """
    known = refine([(0, total)], max(1, -(-total // INTERVALS)))
    while True:

        def best(x: int, hopeful: bool) -> tuple[int, int]:
            """The largest end up to x, and the interval it lies in."""
            i = int(np.searchsorted(known[:, 0], x, "right")) - 1
            if i < 0:
                return 0, -1
            first, last = known[i]
            return int(last if last <= x else x if hopeful else first), i

        def packed(capacity: int, hopeful: bool) -> list[int]:
            cuts, at = [], 0
            while at < total and len(cuts) < shards:
                at = best(at + capacity, hopeful)[0]
                cuts.append(at)
            return cuts

        def least(hopeful: bool) -> int:
            low, high = -(-total // shards) - 1, total
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if packed(middle, hopeful)[-1] >= total else (middle, high)
            return high

        low, high = least(True), least(False)
        if low == high and packed(low, True) == packed(high, False):
            return packed(high, False)
        # Between the earliest and the latest place of each cut.
        ranges: list[tuple[int, int]] = []
        for early, late in zip(packed(low, False), packed(high, True) + [total] * shards, strict=False):
            a, b = max(best(early, False)[1], 0), max(best(late, True)[1], 0)
            ranges.append((int(known[a, 0]), int(known[b, 1])))
        merged: list[list[int]] = []
        for a, b in sorted(ranges):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        span = sum(b - a for a, b in merged)
        closer = refine([(a, b) for a, b in merged], max(1, -(-span // INTERVALS)))
        outside = np.ones(len(known), bool)
        for a, b in merged:
            outside &= (known[:, 1] < a) | (known[:, 0] > b)
        known = np.concatenate([known[outside], closer])
        known = known[np.argsort(known[:, 0], kind="stable")]


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a partition number, the rows and bytes of the partition up to and with each row, and whether the row is
    the partition's last of its group."""
    from pyspark import TaskContext

    part, rows, size, held = TaskContext.get().partitionId(), 0, 0, None

    def numbered(batch: pa.RecordBatch, after: pa.Scalar | None) -> pa.RecordBatch:
        nonlocal rows, size
        n, group = len(batch), batch.column("group")
        last = np.ones(n, bool)
        last[:-1] = pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False)
        if after is not None:
            last[-1] = after != group[-1]
        sizes = size + np.cumsum(batch.column("size").to_numpy())
        added = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows + 1, rows + n + 1)), pa.array(sizes), pa.array(last)]
        rows, size = rows + n, int(sizes[-1])
        return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "part", "part_row", "part_end", "last"])

    for batch in batches:
        if len(batch):
            if held is not None:
                yield numbered(held, batch.column("group")[0])
            held = batch
    if held is not None:
        yield numbered(held, None)


def _intervals(ranges: list[tuple[int, int]], width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last end of each step that has one within the ranges, for each task."""
    seen: dict[int, list[int]] = {}
    lows, highs = (np.array(x) for x in zip(*ranges, strict=True))
    for batch in batches:
        ends = batch.column("end").to_numpy()
        near = np.searchsorted(lows, ends, "right") - 1
        ends = ends[(near >= 0) & (ends <= highs[near])]
        for step, end in zip((ends // width).tolist(), ends.tolist(), strict=True):
            known = seen.setdefault(step, [end, end])
            known[0], known[1] = min(known[0], end), max(known[1], end)
    if seen:
        first, last = zip(*seen.values(), strict=True)
        yield pa.RecordBatch.from_pydict({"first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Deals all rows into ``shards`` shards of nearly equal bytes; equal texts stay together.

    The size of a row is the UTF-8 bytes of its text plus one; a null text has none and counts as equal to an empty
    one. Groups of equal texts are ordered by a digest, and a group larger than an even share gets a shard of its
    own. The others are cut into contiguous runs at the smallest capacity that suffices, found by binary search with
    greedy packing. Rows with equal ``doc_id`` are rows of their own; a null id comes first in its group. Other
    columns are ignored; an empty table gives no rows.

    Returns ``doc_id, size, text_crc32, shard, slot``, with slots from 0 within each shard.

    One range shuffle of narrow rows orders the groups, and splits a group of any size over tasks. The driver holds
    one row for each of its partitions, at most ``shards`` large groups, and the intervals of the cumulative size
    that the search looks at: about 65,000, whatever the number of groups.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("group"),
        )
    )
    spark = docs.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    by_group = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    alone, rest = [], total
    for row in by_group.orderBy(F.desc("size"), "group").limit(shards).collect():
        if len(alone) == shards - 1 or row["size"] * (shards - len(alone)) <= rest:
            break
        alone.append(row)
        rest -= row["size"]
    place = F.lit(len(alone))
    for i, row in enumerate(alone):
        place = F.when(F.col("group") == F.lit(bytes(row["group"])), i).otherwise(place)

    order = ["place", "group", "doc_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("place", place).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "doc_id long, size long, text_crc32 long, group binary, place int, part int, part_row long, part_end long, last boolean"
    ordered = written(ordered.mapInArrow(_running, schema))

    # A few values of every partition: what lies before it, and whether its last group goes on in the next one.
    edge = F.struct("place", "group")
    known = ordered.groupBy("part").agg(
        F.max("part_row").alias("rows"), F.max("part_end").alias("bytes"), F.min(edge).alias("low"), F.max(edge).alias("high")
    ).orderBy("part").collect()
    offsets, row0, byte0 = [], 0, 0
    for i, k in enumerate(known):
        goes_on = i + 1 < len(known) and known[i + 1]["low"] == k["high"]
        offsets.append((k["part"], row0, byte0, k["rows"] if goes_on else 0))
        row0, byte0 = row0 + k["rows"], byte0 + k["bytes"]
    before = spark.createDataFrame(offsets, "part int, rows_before long, bytes_before long, goes_on long")
    placed = ordered.join(F.broadcast(before), "part").select(
        "doc_id", "size", "text_crc32", "place",
        (F.col("rows_before") + F.col("part_row")).alias("row"),
        (F.col("bytes_before") + F.col("part_end")).alias("end"),
        (F.col("last") & (F.col("goes_on") != F.col("part_row"))).alias("last"),
    )
    first_end = total - rest
    ends = placed.where(F.col("last") & (F.col("place") == len(alone))).select((F.col("end") - first_end).alias("end"), "row")

    def refine(ranges: list[tuple[int, int]], width: int) -> np.ndarray:
        found = ends.select("end").mapInArrow(lambda batches: _intervals(ranges, width, batches), "first long, last long").collect()
        # Tasks hold disjoint runs of the order, so that only an interval on their border comes twice.
        got = np.array([[r["first"], r["last"]] for r in found], np.int64).reshape(-1, 2)
        return got[np.argsort(got[:, 0])]

    cuts = _least_capacity(rest, shards - len(alone), refine) if rest else []
    at_cut = {r["end"]: r["row"] for r in ends.where(F.col("end").isin(cuts[:-1])).collect()} if cuts[:-1] else {}
    starts = [(0, 0)]  # of each shard: bytes and rows before it
    for row in alone:
        starts.append((starts[-1][0] + row["size"], starts[-1][1] + row["rows"]))
    starts += [(first_end + c, at_cut[c]) for c in cuts[:-1]]
    number = F.lit(0)
    for start, _ in starts[1:]:
        number = number + (F.col("end") > start).cast("int")
    first_row = F.array(*[F.lit(r).cast("long") for _, r in starts])
    return placed.withColumn("shard", number).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - 1 - F.element_at(first_row, F.col("shard") + 1)).alias("slot")
    )
