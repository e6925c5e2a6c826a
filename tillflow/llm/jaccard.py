"""Jaccard self-join of documents on word shingles, by partitioning the universe of shingles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillflow.llm.components import components
from tillflow.llm.words import NOT_SPACE, chunks, mixed, shingles, words
from tillflow.session import written


#: Shingles are counted by slots of a table of 2**COUNTER_BITS counters; the counts only order the verification.
COUNTER_BITS = 20
COUNTER_BLOCK = 1 << 12
#: Bytes of text whose sets are made at once.
SET_BYTES = 1 << 18
#: In buckets of so many sets all pairs are compared, in larger ones all sets with a pivot.
SMALL_BUCKET = 32


@dataclass(frozen=True)
class Join:
    """What counts as a link: ``100 * intersection >= percent * union`` of the sets of ``n``-word shingles."""

    n: int = 5
    percent: int = 80
    #: Size bands grow by this factor. Two sets that link lie in one band or in neighbouring ones.
    band_growth: float = 1.4
    #: For the cost of an allocation: the chance that two unrelated sets agree on a shingle. It decides how much work there
    #: is, never the result: a larger value makes more index entries, a smaller one more unrelated candidates.
    overlap: float = 0.05

    def __post_init__(self) -> None:
        if not 1 <= self.percent <= 100 or self.band_growth * self.percent < 100:
            raise ValueError("a band must be as wide as the sizes that can link")

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(size, 1)) / math.log(self.band_growth)).astype(np.int64)

    def largest(self, band: int) -> int:
        """No set of the band is larger; one more than that guards against rounding."""
        return int(self.band_growth ** (band + 1)) + 1

    def most_different(self, size: int) -> int:
        """Elements that two linked sets of at most ``size`` have in only one of them."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)


@dataclass(frozen=True)
class Allocation:
    """Segments of the universe that a band compares as they are, and after at most one deletion.

    ``spare`` ones are compared as they are, too, and are more than the tolerance asks for, see ``with_spare``.
    """

    exact: int
    deletion: int
    spare: int = 0

    @property
    def segments(self) -> int:
        return self.exact + self.spare + self.deletion


def allocate(join: Join, band: int, sets: int) -> Allocation:
    """The cheapest split of a band's tolerance over segments, for so many sets in the band.

    If two sets differ in at most h elements, and exact segments count one and deletion segments two, h + 1 in all,
    then some segment differs by no more than it tolerates. The cost of a set is its index entries plus the
    unrelated sets expected under them.
    """
    size, tolerated = join.largest(band), join.most_different(join.largest(band))

    def cost(a: Allocation) -> float:
        per_segment = size / a.segments
        entries = a.exact + a.deletion * (1 + per_segment)
        return entries + sets * (a.exact * join.overlap**per_segment + a.deletion * per_segment * join.overlap ** max(per_segment - 1, 0))

    choices = [Allocation(tolerated + 1 - 2 * q, q) for q in range((tolerated + 1) // 2 + 1)]
    return min(choices, key=cost)


def with_spare(join: Join, band: int, a: Allocation) -> Allocation:
    """The allocation with so many spare segments that nearly every set of the index has elements in ``exact`` of them.

    Such a set needs no entries for segments without elements, which unrelated sets share: those that it has elements in
    are more than a linked set can differ in, so the two agree on one of these. Other sets keep all their entries.
    """
    smallest = join.percent * join.band_growth**band / 100
    for spare in range(a.exact // 2 + 1):
        segments = a.exact + spare
        empty = math.exp(-smallest / (segments + a.deletion))
        if segments * (1 - empty) - 2 * math.sqrt(segments * empty * (1 - empty)) >= a.exact:
            return replace(a, spare=spare)
    return a


def _signatures(elements: np.ndarray, values: np.ndarray, band: int, a: Allocation) -> np.ndarray:
    """Index entries of one set under a band's allocation; ``elements`` are sorted, ``values`` their hashes."""
    edges = (np.arange(1, a.segments, dtype=np.float64) * (2.0**64 / a.segments)).astype(np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(elements, edges), [len(elements)]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    of_segment = sums[cuts[1:]] - sums[cuts[:-1]]
    place = mixed((np.arange(a.segments, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019) + np.uint64(band))
    held, as_they_are = np.diff(cuts), a.exact + a.spare
    indexed = (held > 0) | (np.arange(a.segments) >= as_they_are)
    if np.count_nonzero(indexed[:as_they_are]) < a.exact:
        indexed[:] = True
    out = [mixed(of_segment ^ place)[indexed]]
    if a.deletion:
        # The last segments are those with deletions: each of their elements is left out once.
        low = cuts[as_they_are]
        segment = np.repeat(np.arange(as_they_are, a.segments), held[as_they_are:])
        out.append(mixed((of_segment[segment] - values[low:]) ^ place[segment]))
    return np.unique(np.concatenate(out))


def _sets(join: Join, batches: Iterator[pa.RecordBatch], row: Callable) -> Iterator[pa.RecordBatch]:
    """Applies ``row(doc_id, set)`` to the sorted distinct shingle hashes of every text; yields its results."""
    for batch in batches:
        ids = batch.column("doc_id")
        for chunk in chunks(batch.column("text"), SET_BYTES):
            found = words(chunk, NOT_SPACE)
            runs = shingles(found.hashes, join.n)
            rows = []
            for i, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)):
                if b - a >= join.n:
                    elements = np.unique(runs[a : b - join.n + 1])
                else:  # the whole sequence, if there is any
                    elements = shingles(found.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)
                rows.append(row(ids[chunk.low + i].as_py(), elements))
            yield from (r for r in rows if isinstance(r, pa.RecordBatch))
            yield _columns([r for r in rows if r is not None])


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    """A batch of rows of numbers and, at the end, perhaps an array of numbers."""
    if not rows:
        return pa.RecordBatch.from_pylist([])
    names = [f"c{i}" for i in range(len(rows[0]))]
    columns = []
    for values in zip(*rows, strict=True):
        if isinstance(values[0], np.ndarray):
            offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).view(np.int64))))
        else:
            columns.append(pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names)


def _key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    values = mixed(elements + np.uint64(1))
    one, two = values.sum(dtype=np.uint64), mixed(values).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def _sketch(elements: np.ndarray) -> np.ndarray:
    """A bit for each slot that an odd number of elements is in; as many slots as elements or up to twice as many.

    Where the sketches of two sets differ, an element is in one of them only. So there are at least as many of these.
    """
    slots = max(64, 1 << (len(elements) - 1).bit_length()) if len(elements) else 64
    odd = np.bincount((mixed(elements ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _sketches_differ(one: np.ndarray, other: np.ndarray) -> int:
    """In how many slots; the slots of the larger sketch are folded to those of the smaller one."""
    slots = min(len(one), len(other))
    one, other = (np.bitwise_xor.reduce(x.reshape(-1, slots), axis=0) for x in (one, other))
    return int(np.bitwise_count(one ^ other).sum())


def _map(docs: DataFrame, join: Join, row: Callable, names: str) -> DataFrame:
    columns = names.split()
    schema = ", ".join(f"{c.strip('*')} {'array<long>' if c.endswith('*') else 'long'}" for c in columns)
    plain = [c.strip("*") for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sets(join, batches, row):
            if batch.num_columns:
                yield batch.rename_columns(plain)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _entries(docs: DataFrame, join: Join, plan: Mapping[int, Allocation], copied: DataFrame) -> DataFrame:
    """``(node, signature)``: the index entries of every different set; its node is the smallest id that has it.

    Only the sets of the ``copied`` documents, which other rows have too, are brought together to find the smallest id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def row(doc_id: int | None, elements: np.ndarray) -> tuple | None:
        n = len(elements)
        if doc_id is None or not n:
            return None
        band = int(join.band(np.array(n)))
        values = mixed(elements ^ np.uint64(0xD1B54A32D192ED03))
        # As the larger set of a pair, or both in one band; and as the smaller one of a pair with the next band.
        found = [_signatures(elements, values, b, plan[b]) for b in (band, band + 1) if b in plan and (b == band or 100 * n >= join.percent * (join.band_growth**b - 1))]
        return *_key(elements), doc_id, np.unique(np.concatenate(found))

    names = "k1 k2 doc_id signatures*"
    of_copies = _map(docs.join(copied, "doc_id", "left_semi"), join, row, names)
    of_copies = of_copies.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("signatures").alias("signatures"))
    alone = _map(docs.join(copied, "doc_id", "left_anti"), join, row, names).select(F.col("doc_id").alias("node"), "signatures")
    return alone.unionByName(of_copies.select("node", "signatures")).select("node", F.explode("signatures").alias("signature"))


def linked(docs: DataFrame, join: Join = Join()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The self-join: documents with their set, and the components and links of different sets.

    Returns three written tables: ``doc_id, n_shingles, node`` for every row (``node`` is the smallest id with the
    same set, null without words or id); ``node, component`` for nodes that have links; ``a, b`` with the links
    that were verified. They are enough to connect whatever any links connect; sets that are connected anyway are not
    compared with each other.

    A set is the distinct ``n``-word shingles of the text, or the whole sequence if it has fewer words. Two linked
    sets differ in few shingles, so when the universe is cut into one segment more than that, they agree on one.
    Sets are indexed by the shingles they have in each segment, under the segments of their size band. Equal
    entries make buckets of candidates. Of the pairs in small buckets those are verified whose sketches differ no more
    than linked sets can; large buckets are verified against pivots (see ``_connected``).

    A null text has no words. Rows that repeat a ``doc_id`` count as one document. Other columns are ignored.
    """

    def size_row(doc_id: int | None, elements: np.ndarray) -> tuple:
        return (*_key(elements), doc_id, len(elements), _sketch(elements))

    sets = written(_map(docs, join, size_row, "k1 k2 doc_id n_shingles sketch*"))
    # A few rows: one for each band.
    band = F.floor(F.log(F.greatest(F.col("n_shingles"), F.lit(1))) / math.log(join.band_growth))
    counts = {int(r["band"]): int(r["n"]) for r in sets.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = {b: with_spare(join, b, allocate(join, b, n)) for b, n in counts.items()}

    named = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = written(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")))
    copied = written(named.join(nodes.where("n > 1"), ["k1", "k2"], "left_semi").select("doc_id").distinct())
    nodes = nodes.drop("n")
    bucket = Window.partitionBy("signature").orderBy("node")
    entries = _entries(docs, join, plan, copied).select(
        "signature", "node", F.lag("node").over(bucket).alias("before"), F.lead("node").over(bucket).alias("after")
    )
    buckets = written(entries.where("before IS NOT NULL OR after IS NOT NULL").select(F.col("signature").alias("bucket"), "node"))
    of_bucket = Window.partitionBy("bucket")
    sized = buckets.withColumn("large", F.count(F.lit(1)).over(of_bucket) > SMALL_BUCKET)
    large = written(sized.where("large").select("bucket", "node"))
    near = written(_near(_pairs(sized.where("NOT large")), named, join))
    wanted = near.select("node").unionByName(near.select(F.col("pivot").alias("node"))).unionByName(large.select("node"))
    members = written(_texts(docs, join, wanted.distinct()))
    links, parts = _connected(large, near, members, join)
    node = F.when(F.col("doc_id").isNotNull(), F.col("node"))
    return sets.join(nodes, ["k1", "k2"], "left").select("doc_id", "n_shingles", node.alias("node")), parts, links


def _pairs(buckets: DataFrame) -> DataFrame:
    """All different pairs ``pivot < node`` within small buckets."""
    ordered = Window.partitionBy("bucket").orderBy("node")
    after = F.array(*(F.lead("node", k).over(ordered) for k in range(1, SMALL_BUCKET)))
    followed = buckets.select(F.col("node").alias("pivot"), after.alias("after"))
    return followed.select("pivot", F.explode("after").alias("node")).where("pivot < node").distinct()


def _near(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Those of the pairs that may link by their sizes and sketches.

    A document of which rows have different sets is not told from others by these.
    """
    one = F.min("k1") == F.max("k1")
    sketches = sets.groupBy("doc_id").agg(F.when(one, F.first("n_shingles")).alias("size"), F.when(one, F.first("sketch")).alias("sketch"))
    both = pairs.join(sketches.toDF("node", "size", "sketch"), "node").join(sketches.toDF("pivot", "other_size", "other_sketch"), "pivot")
    fits = 100 * F.least("size", "other_size") >= join.percent * F.greatest("size", "other_size")
    both = both.where(F.coalesce(fits, F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch.column(c) for c in ("sketch", "other_sketch"))
            sizes = zip(batch.column("size").to_pylist(), batch.column("other_size").to_pylist(), strict=True)
            kept = [
                x is None or y is None
                or (100 + join.percent) * _sketches_differ(one[i].values.to_numpy().view(np.uint64), other[i].values.to_numpy().view(np.uint64)) <= (100 - join.percent) * (x + y)
                for i, (x, y) in enumerate(sizes)
            ]
            yield batch.select(["pivot", "node"]).filter(pa.array(kept, pa.bool_()))

    return both.select("pivot", "node", "size", "other_size", "sketch", "other_sketch").mapInArrow(run, "pivot long, node long")


def _connected(buckets: DataFrame, near: DataFrame, members: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """Verified links that connect whatever is connected by links within buckets, and the components.

    ``near`` are the pairs of small buckets that may link. In every large bucket all members are verified against one of them, the pivot p. What remains are links between two
    others, x and y. With ``a(x)`` the shingles in which x differs from p and ``b(x) = a(x) - k |x|``, where
    ``k = (100 - percent) / (100 + percent)``, they link exactly if their differences from p have
    ``(b(x) + b(y)) / 2`` elements in common. If that is nothing, both link to p. Else they share an element of the
    first ``a - o + 1`` in a fixed order, if they must share o; what p lacks comes first, and the rare before the
    common, so that what all but p have in common stays behind. The one with
    the smaller b shares b(y) at least, which leaves a short prefix; the other one cannot be further from it than what
    the smaller can have in common with it; and where they first meet, enough must be left of both. So near copies
    meet again only if they differ from the pivot in the same way, and a large group costs about as many candidates
    as it has members. The pivot is the member whose shingles most candidates have; any other would give the same
    links.
    """
    ranked = buckets.join(members.select("node", "weight"), "node")
    pivot = F.first("node").over(Window.partitionBy("bucket").orderBy(F.desc("weight"), "node"))
    pairs = ranked.select(pivot.alias("pivot"), "node").where("node <> pivot").distinct().withColumn("large", F.lit(True))
    pairs = pairs.unionByName(near.withColumn("large", F.lit(False))).groupBy("pivot", "node").agg(F.max("large").alias("large"))
    tried = written(_tried(pairs, members, join))
    links = written(tried.where("linked").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")))
    parts = written(components(links))

    placed = tried.where("as_smaller IS NOT NULL").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # A bucket for each pivot and element; that two of them may share a hash does no harm.
    # ``room``: elements from the shared one on, which are all that two sets that first meet there have in common.
    role = lambda prefix: placed.select(
        F.posexplode(F.transform(prefix, lambda shingle: F.xxhash64("pivot", shingle))).alias("place", "bucket"), "node", "b", "a", "component"
    ).select("bucket", "node", "b", (F.col("a") - F.col("place")).alias("room"), "component")
    y, x = role("as_smaller"), role("as_larger").toDF("bucket", "other", "other_b", "other_room", "other_component")
    meeting = y.join(x, "bucket").where("component <> other_component AND (b < other_b OR b = other_b AND node < other)")
    meeting = meeting.where(2 * (100 + join.percent) * F.least("room", "other_room") >= F.col("b") + F.col("other_b"))
    candidates = written(meeting.select(F.least("node", "other").alias("pivot"), F.greatest("node", "other").alias("node")).distinct())
    found = _tried(candidates.withColumn("large", F.lit(False)), members, join).where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = written(links.unionByName(found))
    return links, written(components(links))


def _slots(elements: np.ndarray) -> np.ndarray:
    return (mixed(elements) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _counted(join: Join, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counters, in blocks."""
    total = np.zeros(1 << COUNTER_BITS, np.int64)

    def add(doc_id: int | None, elements: np.ndarray) -> None:
        np.add.at(total, _slots(elements), 1)

    for _ in _sets(join, batches, add):
        pass
    blocks = total.reshape(-1, COUNTER_BLOCK)
    held = np.flatnonzero(blocks.any(axis=1))
    offsets = np.arange(len(held) + 1, dtype=np.int32) * COUNTER_BLOCK
    counts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(blocks[held].ravel().astype(np.int32)))
    yield pa.RecordBatch.from_arrays([pa.array(held), counts], ["block", "counts"])


def _added(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
    counts = np.zeros(COUNTER_BLOCK, np.int64)
    for values in rows.column("counts"):
        counts += values.values.to_numpy()
    return pa.table({"block": [key[0].as_py()], "counts": pa.array([counts], pa.list_(pa.int64()))})


def _counters(docs: DataFrame, join: Join) -> np.ndarray:
    """In how many documents the shingles of each slot are; a table of fixed size, whatever the documents."""
    found = docs.mapInArrow(lambda batches: _counted(join, batches), "block long, counts array<int>")
    out = np.zeros((1 << COUNTER_BITS) // COUNTER_BLOCK * COUNTER_BLOCK, np.int64)
    for row in found.groupBy("block").applyInArrow(_added, "block long, counts array<long>").toLocalIterator():
        out[row["block"] * COUNTER_BLOCK : (row["block"] + 1) * COUNTER_BLOCK] = row["counts"]
    return out


def _texts(docs: DataFrame, join: Join, nodes: DataFrame) -> DataFrame:
    """``(node, weight, elements)`` of the candidates, from their texts: their shingles, those of the slots that the
    fewest candidates have first, and in how many candidates a slot of theirs is on average."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = written(wanted.join(written(nodes).withColumnRenamed("node", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    shared = docs.sparkSession.sparkContext.broadcast(_counters(wanted, join))

    def row(doc_id: int | None, elements: np.ndarray) -> tuple:
        counts = shared.value[_slots(elements)]
        return doc_id, int(256 * counts.mean()) if len(counts) else 0, elements[np.lexsort((elements, counts))]

    return _map(wanted, join, row, "node weight elements*")


def _tried(pairs: DataFrame, members: DataFrame, join: Join) -> DataFrame:
    """For pairs of ``pivot`` and ``node``: whether they are ``linked``; b of the node, in parts of 100 + percent; and, if
    the bucket is ``large``, the prefixes of its difference from the pivot as the one with the smaller and with the larger b."""
    of_node = members.select("node", F.col("elements").alias("own"))
    of_pivot = members.select(F.col("node").alias("pivot"), F.col("elements").alias("other"))
    both = pairs.join(of_node, "node").join(of_pivot, "pivot")
    both = both.withColumn("difference", F.concat(F.array_except("own", "other"), F.array_except("other", "own")))
    whole, part = 100 + join.percent, 100 - join.percent
    n, a = F.size("own"), F.size("difference")
    both = both.withColumn("b", whole * a.cast("long") - part * n)
    # a <= k (|x| + |p|)
    linked_now = whole * a <= part * (n + F.size("other"))

    def prefix(least: Column) -> Column:
        shared = F.greatest(F.ceil(least / F.lit(whole)).cast("int"), F.lit(1))
        return F.when(F.col("large"), F.slice("difference", F.lit(1), F.greatest(a - shared + 1, F.lit(0))))

    largest_partner = F.floor(100 * n / F.lit(join.percent))
    return both.select(
        "pivot", "node", linked_now.alias("linked"), "b", a.alias("a"),
        prefix(F.col("b")).alias("as_smaller"), prefix(F.col("b") - part * largest_partner).alias("as_larger"),
    )


def near_classes(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: its set's size and the smallest id reachable by links.

    A document without words is alone; without an id, too, and then ``component_id`` is null. An empty table gives
    no rows.
    """
    doc_nodes, parts, _ = linked(docs, join)
    joined = doc_nodes.join(parts, "node", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
