"""Stupid-backoff scores of documents under n-gram counts of the same corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.words import ALNUM, chunks, mixed, words
from tillflow.session import written

#: UTF-8 bytes of the texts whose n-grams are counted together before they are shuffled.
BLOCK_BYTES = 16 << 20
#: Entries of the count table that one group of the merge holds on average.
BUCKET_KEYS = 1 << 21


@dataclass(frozen=True)
class LanguageModel:
    """Longest n-gram; what a shorter context costs; and whether the occurrence that is scored counts for itself.

    A corpus that is scored under its own counts holds every n-gram at least once. If the scored occurrence counts too,
    nothing ever backs off; so it is left out, and what counts are the other occurrences.
    """

    order: int = 3
    backoff: float = 0.4
    own: bool = False

    @property
    def left_out(self) -> int:
        return 0 if self.own else 1


class _Block:
    """The words of a block of documents, and the counts of their n-grams as far as they are known.

    ``counts`` are those of the occurrences that speak for a word. An n-gram has others beside the scored one only if the
    two shorter n-grams within it have. So the keys of order k are those whose parts have others; the rest has none, and
    asking the count table would tell nothing else.
    """

    def __init__(self, texts: pa.ChunkedArray, model: LanguageModel, buckets: int):
        self.model, self.buckets = model, buckets
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for chunk in chunks(texts):
            found = words(chunk, ALNUM)
            hashes.append(found.hashes)
            counts.append(np.diff(found.first))
        self.hashes, self.n_words = np.concatenate(hashes), np.concatenate(counts)
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        self.grams = self.hashes  # of the order at hand; entry i ends at word i
        self.at = np.arange(len(self.hashes))  # words at which an n-gram of this order ends that can have occurrences
        self.order = 1
        #: For each order, the count of the n-gram that ends at each word, without the scored one if it is left out.
        self.counts: list[np.ndarray] = []

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different n-grams of the order at hand by bucket, how often each occurs here, and where buckets begin."""
        keys, self.inverse, n = np.unique(self.grams[self.at], return_inverse=True, return_counts=True)
        # Buckets are ranges of keys, which are hashes.
        edges = (np.arange(1, self.buckets, dtype=np.float64) * (2.0**64 / self.buckets)).astype(np.uint64)
        return keys, n, np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])

    def learn(self, rows: list[bytes]) -> None:
        """Takes the corpus counts of the n-grams of the order at hand, bucket by bucket, and goes on to the next order."""
        _, _, first = self.keys()
        totals = np.concatenate([_unpacked_counts(r, int(n)) for r, n in zip(rows, np.diff(first), strict=True)])
        count = np.zeros(len(self.hashes), np.int64)
        found = totals[self.inverse]
        count[self.at] = found - self.model.left_out
        self.counts.append(count)
        self.order += 1
        good = count > 0
        longer = np.zeros(len(good), bool)
        longer[1:] = good[1:] & good[:-1]
        place = np.arange(len(self.doc)) - np.concatenate([[0], np.cumsum(self.n_words)])[self.doc]
        longer &= place >= self.order - 1
        # A hash of the whole n-gram from that of its first words and its last word.
        joined = np.zeros(len(self.hashes), np.uint64)
        joined[1:] = mixed(self.grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[1:] + np.uint64(self.order))
        self.grams, self.at = joined, np.flatnonzero(longer)

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: the sum of log scores but for the corpus size, words scored alone, and words backed off."""
        n, order = len(self.hashes), self.model.order
        place = np.arange(n) - np.concatenate([[0], np.cumsum(self.n_words)])[self.doc]
        # A word alone scores its share of all words, itself among them, so that no score is zero.
        log = np.log((self.counts[0] + self.model.left_out).astype(np.float64)) if n else np.zeros(0)
        used = np.ones(n, np.int64)
        for k in range(2, order + 1):
            have = np.flatnonzero(self.counts[k - 1] > 0)
            log[have] = np.log(self.counts[k - 1][have] / self.counts[k - 2][have - 1])
            used[have] = k
        back = np.minimum(place + 1, order) - used
        log += back * math.log(self.model.backoff)
        total = lambda x: np.bincount(self.doc, x, len(self.n_words))
        return total(log), total(used == 1), total(back > 0)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Increasing numbers as differences, byte by byte, so that the high bytes, mostly zero, compress away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; those from 255 on follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpacked_counts(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data[n:], np.int64)
    return counts


def _known(block: _Block, totals: pa.Table) -> _Block:
    """Hands the block its totals, order by order."""
    rows = sorted(zip(*(totals.column(c).to_pylist() for c in ("gram_order", "bucket", "totals")), strict=True), key=lambda r: r[:2])
    for order in sorted({r[0] for r in rows}):
        block.learn([r[2] for r in rows if r[0] == order])
    return block


def _merge(table: pa.Table) -> pa.Table:
    """Adds up the counts of a bucket's keys over all blocks, and gives each block the sums of its own keys."""
    keys = [_unpacked_keys(k) for k in table.column("keys").to_pylist()]
    counts = [_unpacked_counts(c, len(k)) for c, k in zip(table.column("counts").to_pylist(), keys, strict=True)]
    different, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    # The sums of whole numbers are exact in a double up to 2**53.
    sums = np.bincount(inverse, np.concatenate(counts), len(different)).astype(np.int64)[inverse]
    split = np.split(sums, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({
        "block": table.column("block"), "gram_order": table.column("gram_order"), "bucket": table.column("bucket"),
        "totals": pa.array(map(_packed_counts, split), pa.binary()),
    })


def score(docs: DataFrame, model: LanguageModel = LanguageModel(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores every document under the n-gram counts of all documents.

    Words are runs of letters and digits, A-Z lower-cased. A word scores the share of its n-gram among the
    occurrences of the context, for the longest n-gram up to ``order`` that occurs in the corpus; every word by which the
    context is shortened multiplies the score by ``backoff``; a word alone scores its share of all words. All n-grams
    count, but the scored occurrence itself is left out of its n-gram's and its context's count (see
    :class:`LanguageModel`); a word alone counts with itself. Returns ``doc_id, n_words, n_backed_off,
    log_score, mean_log_score`` for every row: the words that were backed off, the sum of the logarithms and their
    mean (null without words). A null text has no words; rows that repeat an id are documents of their own; other
    columns are ignored.

    Documents are dealt into blocks by a hash. For each order, a block sends its different n-grams with their counts
    to the hash partitions of the count table, which add them up and return the sums. The next order takes only
    n-grams whose parts have occurrences beside the scored one; the others can have none. Texts are shuffled once; blocks and buckets hold a bounded number of
    bytes on average at any size of the corpus, so a word that makes up a third of the corpus is one entry of each
    block.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    # About six bytes make a word; a block's words are different n-grams at worst.
    buckets = max(1, -(-int(size) // (6 * BUCKET_KEYS)))
    of_id = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).alias("block"))
    key_schema = "bucket long, block long, gram_order int, keys binary, counts binary"

    def sent(number: int, block: _Block) -> pa.Table:
        keys, n, first = block.keys()
        rows = [(b, _packed_keys(keys[low:high]), _packed_counts(n[low:high])) for b, (low, high) in enumerate(pairwise(first))]
        return pa.table({
            "bucket": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([number] * len(rows), pa.int64()),
            "gram_order": pa.array([block.order] * len(rows), pa.int32()),
            "keys": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary()),
        })

    def first_keys(key: tuple, table: pa.Table) -> pa.Table:
        return sent(key[0].as_py(), _Block(table.column("text"), model, buckets))

    def next_keys(key: tuple, table: pa.Table, totals: pa.Table) -> pa.Table:
        return sent(key[0].as_py(), _known(_Block(table.column("text"), model, buckets), totals))

    def last(key: tuple, table: pa.Table, totals: pa.Table) -> pa.Table:
        block = _known(_Block(table.column("text"), model, buckets), totals)
        log, alone, back = block.scores()
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": pa.array(block.n_words, pa.int64()), "log": pa.array(log, pa.float64()),
            "alone": pa.array(alone.astype(np.int64)), "n_backed_off": pa.array(back.astype(np.int64)),
        })

    totals = None
    for order in range(1, model.order + 1):
        by_block = rows.groupBy("block")
        if totals is None:
            keys = by_block.applyInArrow(first_keys, key_schema)
        else:
            keys = by_block.cogroup(totals.groupBy("block")).applyInArrow(next_keys, key_schema)
        merged = keys.groupBy("bucket").applyInArrow(_merge, "block long, gram_order int, bucket long, totals binary")
        totals = merged if totals is None else totals.unionByName(merged)
    result_schema = f"doc_id {of_id}, n_words long, log double, alone long, n_backed_off long"
    sums = written(rows.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(last, result_schema))
    total = sums.agg(F.sum("n_words")).first()[0] or 0
    log_score = F.col("log") - F.col("alone") * math.log(max(total, 1))
    return sums.select(
        "doc_id", "n_words", "n_backed_off", log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"),
    )
