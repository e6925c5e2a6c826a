"""Resampling towards a target: documents drawn in proportion to how much more the target has of their features."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runs import checksums, runs
from tillflow.llm.words import ALNUM, Chunk, chunks
from tillflow.session import written

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Words whose checksums are worked out together.
BLOCK_WORDS = 1 << 17
#: Thresholds that one counting job tries.
TRIED = 63


@dataclass(frozen=True)
class Draw:
    """What counts as a feature, and which share of the documents is drawn."""

    buckets: int = 10_000
    seed: int = 2024
    #: Documents with fewer words are not drawn.
    least_words: int = 20
    percent: int = 10


def _buckets(chunk: Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word of a chunk, and of each row its first word, one entry more than rows."""
    data = _LOWER[chunk.data]
    starts, ends = runs(data, chunk.bounds, ALNUM)
    out = np.empty(len(starts), np.int32)
    for low in range(0, len(starts), BLOCK_WORDS):
        block = slice(low, low + BLOCK_WORDS)
        out[block] = checksums(data, starts[block], ends[block]) % np.uint32(buckets)
    return out, np.searchsorted(starts, chunk.bounds)


def _histogram(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            total += np.bincount(_buckets(chunk, buckets)[0], minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(held.astype(np.int32)), "n": pa.array(total[held])})


def histogram(texts: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of words in each bucket, over the whole ``text`` column; ``buckets`` sums reach the driver."""
    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(lambda batches: _histogram(buckets, batches), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket a thousand times the log of its share in the target over that in the source, rounded down.

    Every bucket counts one occurrence more than it has.
    """
    n_source, n_target, n = float(source.sum()), float(target.sum()), float(len(source))
    ratio = (target + 1.0) * (n_source + n) / ((source + 1.0) * (n_target + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _weighed(gain: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            bucket, first = _buckets(chunk, len(gain))
            sums = np.zeros(len(bucket) + 1, np.int64)
            np.cumsum(gain[bucket], out=sums[1:])
            n = np.diff(first)
            weight = (sums[first[1:]] - sums[first[:-1]]) // np.maximum(n, 1)
            rows = batch.slice(chunk.low, chunk.high - chunk.low)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(weight)], ["doc_id", "n_features", "weight"])


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_features, weight`` of every row: the mean gain of its words, rounded down; 0 without words."""
    of_id = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string").alias("text")
    return docs.select("doc_id", text).mapInArrow(lambda batches: _weighed(gain, batches), f"doc_id {of_id}, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate that the document's id decides, rounded down.

    Adding it to a log weight and keeping the largest sums is drawing without replacement in proportion to weights.
    """
    digest = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), "UTF-8"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _least(low: int, high: int, needed: int, count: Callable[[list[int]], list[int]]) -> int:
    """The smallest value in ``low..high`` for which at least ``needed`` rows are counted; ``high`` has as many.

    ``count`` takes ascending values and returns their counts, which don't fall. Every job narrows the range to a
    64th, so that 64 bits take eleven jobs at most.
    """
    while low < high:
        step = max(1, -(-(high - low) // (TRIED + 1)))
        tried = list(range(low + step - 1, high, step))
        counts = count(tried)
        enough = next((i for i, n in enumerate(counts) if n >= needed), len(tried))
        low, high = (tried[enough - 1] + 1 if enough else low), (tried[enough] if enough < len(tried) else high)
    return low


def _counter(rows: DataFrame, value: Column) -> Callable[[list[int]], list[int]]:
    """Counts, in one job, the rows whose value is at most each of some thresholds."""

    def count(tried: list[int]) -> list[int]:
        row = rows.agg(*(F.count_if(value <= F.lit(t).cast("long")).alias(f"n{i}") for i, t in enumerate(tried))).first()
        return list(row)

    return count


def _range(rows: DataFrame, value: Column) -> tuple[int, int]:
    row = rows.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    return row["low"], row["high"]


def _ranked(chosen: DataFrame, drawn: int) -> DataFrame:
    """Numbers the chosen rows by descending score and ascending id; numbers over ``drawn`` become null."""
    spark = chosen.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    parts = max(1, -(-drawn // 1_000_000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Within a partition the lower 33 bits of this id count the rows.
    place = (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1).alias("place")
    ordered = chosen.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = written(ordered.select("doc_id", "n_features", "weight", "score", F.spark_partition_id().alias("part"), place))
    before, offsets = 0, []
    for row in ordered.groupBy("part").agg(F.max("place").alias("rows")).orderBy("part").collect():  # a row for each partition
        offsets.append((row["part"], before))
        before += row["rows"]
    offset = spark.createDataFrame(offsets, "part int, before long")
    rank = F.col("before") + F.col("place")
    return ordered.join(F.broadcast(offset), "part").select("doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, rule: Draw = Draw()) -> DataFrame:
    """Draws ``percent`` of the documents with enough words, in proportion to how alike they are to ``target``.

    Words (runs of letters and digits, A-Z lower-cased) fall into ``buckets`` by CRC-32. The weight of a document is the
    mean over its words of the buckets' log ratio of frequencies in the target and in the documents; with hashed Gumbel
    noise it is the document's score. Of ``N`` documents with ``least_words`` the ``percent * N // 100`` with the highest
    scores are drawn, ties to the smaller ``doc_id``, a null id last.

    Returns for every row ``doc_id, n_features, weight, score, rank``, ``rank`` from 1 for the drawn ones, else null. A
    null or empty text has no words and weight 0. Rows that share an id are rows of their own; those that agree in all
    values are told apart by their place in the written table. Other columns are ignored; an empty table, or one without
    enough words, draws nothing.

    Texts are read twice, for the counts and for the weights, and never move. The cutoff is found by counting jobs over
    the written scores, which narrow first the score and then the id within the tied rows; only counts reach the driver.
    The chosen rows are put into ranges that also cut ties, so that no value has to fit into a task.
    """
    n = rule.buckets
    gain = gains(histogram(docs, n), histogram(target, n))
    of_id = docs.schema["doc_id"].dataType.simpleString()
    weighed = weigh(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), rule.seed))
    scored = written(weighed.withColumn("row", F.monotonically_increasing_id()))
    undrawn = F.lit(None).cast("long").alias("rank")
    able = scored.where(F.col("n_features") >= rule.least_words)
    drawn = rule.percent * able.count() // 100
    if not drawn:
        return scored.select("doc_id", "n_features", "weight", "score", undrawn)

    # Scores downwards: the largest value whose rows, with all above it, are enough.
    downward = -F.col("score")
    cutoff = -_least(*_range(able, downward), drawn, _counter(able, downward))
    missing = drawn - able.where(F.col("score") > cutoff).count()
    tied = able.where(F.col("score") == cutoff)
    in_cut = F.lit(True)
    if of_id in ("tinyint", "smallint", "int", "bigint"):
        last = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
        in_cut = last <= F.lit(_least(*_range(tied, last), missing, _counter(tied, last))).cast("long")
    chosen = reduce(lambda a, b: a & b, [F.col("n_features") >= rule.least_words, (F.col("score") > cutoff) | ((F.col("score") == cutoff) & in_cut)])
    rest = scored.where(~chosen).select("doc_id", "n_features", "weight", "score", undrawn)
    return _ranked(scored.where(chosen), drawn).unionByName(rest)
