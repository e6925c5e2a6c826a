"""Passages of a benchmark within documents, found by FM-indexes over shards of the documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.fmindex import FMIndex
from tillflow.llm.words import ALNUM, chunks, hash_words, words

#: Words of a window; a shorter item is one window.
WINDOW = 13
#: A shard is indexed when it has so many words that can be part of a window, or so many documents.
SHARD_WORDS = 1 << 20
SHARD_DOCS = 1 << 14
#: Text of the benchmark that is searched for at once; a larger benchmark is searched for in several blocks.
BLOCK_BYTES = 16 << 20

SPANS = "array<struct<first:int,last:int,start:int,end:int>>"


@dataclass(frozen=True)
class Phrases:
    """The windows of a block of the benchmark as rows of word numbers from 1, padded on the left."""

    vocabulary: np.ndarray  # sorted hashes of the words
    rows: np.ndarray
    lengths: np.ndarray
    first: np.ndarray  # of each window, its first entry in items
    items: np.ndarray  # numbers of the items that have the window
    names: list[str]

    @staticmethod
    def of(names: list[str], texts: list[str], window: int) -> Phrases | None:
        hashed = hash_words(texts, ALNUM)
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]))
        rows, owner = [], []
        for item, word in enumerate(hashed):
            number = np.searchsorted(vocabulary, word) + 1
            if len(number):
                k = min(window, len(number))
                block = np.zeros((len(number) - k + 1, window), np.int64)
                block[:, window - k :] = np.lib.stride_tricks.sliding_window_view(number, k)
                rows.append(block)
                owner.append(np.full(len(block), item))
        if not rows:
            return None
        different, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate(owner)], axis=1), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(different) + 1))
        return Phrases(vocabulary, different, (different > 0).sum(axis=1), first, pairs[:, 1], names)


class _Shard:
    """Documents gathered until there are enough for an index."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.shortest = phrases, int(phrases.lengths.min())
        self.clear()

    def clear(self) -> None:
        self.rows: list[pa.RecordBatch] = []
        self.n_words: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs = self.size = 0

    def add(self, batch: pa.RecordBatch, chunk) -> None:
        """Takes a chunk's documents, and of their words those that can be part of a window.

        Words that no window has end a run; a run shorter than every window holds none and is left out.
        """
        found = words(chunk, ALNUM)
        vocabulary = self.phrases.vocabulary
        number = np.minimum(np.searchsorted(vocabulary, found.hashes), len(vocabulary) - 1)
        inside = vocabulary[number] == found.hashes
        counts = np.diff(found.first)
        breaks = np.zeros(len(inside) + 1, bool)
        breaks[found.first] = True
        breaks[:-1] |= ~inside
        breaks[1:] |= ~inside
        edges = np.flatnonzero(breaks)
        long = np.diff(edges) >= self.shortest
        long &= inside[edges[:-1]] if len(edges) > 1 else long
        lows, highs = edges[:-1][long], edges[1:][long]
        lengths = highs - lows
        kept = np.repeat(lows - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lows) else lows, lengths) + np.arange(lengths.sum())
        doc = np.searchsorted(found.first, kept, "right") - 1
        before = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
        origin = before[chunk.bounds[doc]]
        self.parts.append((
            number[kept] + 1, np.repeat(np.arange(len(lengths)), lengths), doc + self.docs, kept - found.first[doc],
            before[found.starts[kept]] - origin, before[found.ends[kept]] - origin,
        ))
        self.rows.append(batch)
        self.n_words.append(counts)
        self.docs += len(counts)
        self.size += len(kept)

    def results(self) -> tuple[np.ndarray, dict[int, tuple[list, list]]]:
        """Words of each document, and the spans and items of documents that have any."""
        n_words = np.concatenate([np.zeros(0, np.int64), *self.n_words])
        out: dict[int, tuple[list, list]] = {}
        if not self.size:
            return n_words, out
        number, run, doc, word, start, end = (np.concatenate(x) for x in zip(*self._numbered(), strict=True))
        # Runs are kept apart by a number of their own.
        apart = len(self.phrases.vocabulary) + 1
        gap = np.concatenate([[0], np.cumsum(np.diff(run) != 0)])
        sequence = np.full(len(number) + int(gap[-1]) + 1, apart, np.int64)
        place = np.arange(len(number)) + gap
        sequence[place] = number
        index = FMIndex(sequence, apart)
        low, high = index.search(self.phrases.rows, self.phrases.lengths)
        times = high - low
        hits = np.flatnonzero(times)
        times = times[hits]
        if not len(hits):
            return n_words, out
        rows = np.repeat(low[hits] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        window = np.repeat(hits, times)
        at = np.searchsorted(place, index.locate(rows))
        covers = np.zeros(len(number) + 1, np.int64)
        np.add.at(covers, at, 1)
        np.add.at(covers, at + self.phrases.lengths[window], -1)
        covered = np.cumsum(covers[:-1]) > 0
        inside = np.flatnonzero(covered)
        new = np.ones(len(inside), bool)
        new[1:] = (doc[inside][1:] != doc[inside][:-1]) | (word[inside][1:] != word[inside][:-1] + 1)
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(inside)) - 1
        for a, b in zip(inside[firsts].tolist(), inside[lasts].tolist(), strict=True):
            span = {"first": int(word[a]), "last": int(word[b]), "start": int(start[a]), "end": int(end[b])}
            out.setdefault(int(doc[a]), ([], []))[0].append(span)
        pairs = np.unique(np.stack([doc[at], window], axis=1), axis=0)
        for d, w in pairs.tolist():
            out[d][1].extend(self.phrases.items[self.phrases.first[w] : self.phrases.first[w + 1]].tolist())
        return n_words, {d: (spans, sorted({self.phrases.names[i] for i in items})) for d, (spans, items) in out.items()}

    def _numbered(self) -> Iterator[tuple[np.ndarray, ...]]:
        runs = 0
        for number, run, *rest in self.parts:
            yield number, run + runs, *rest
            runs += int(run[-1]) + 1 if len(run) else 0


def _merged(one: list[dict], two: list[dict]) -> list[dict]:
    """Spans that overlap or touch become one."""
    out: list[dict] = []
    for span in sorted([*one, *two], key=lambda s: (s["first"], s["last"])):
        if out and span["first"] <= out[-1]["last"] + 1:
            if span["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": span["last"], "end": span["end"]}
        else:
            out.append(span)
    return out


def _search(phrases: Phrases, with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds what a block of the benchmark hits to the spans and items of earlier blocks."""
    shard = _Shard(phrases)

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(shard.rows).combine_chunks().to_batches()[0]
        n_words, found = shard.results()
        spans, items = table.column("spans").to_pylist(), table.column("items").to_pylist()
        for d, (more, names) in found.items():
            spans[d] = _merged(spans[d], more)
            items[d] = sorted({*items[d], *names})
        columns = {
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "spans": pa.array(spans, table.schema.field("spans").type),
            "items": pa.array(items, table.schema.field("items").type),
        }
        if with_text:
            columns["text"] = table.column("text")
        shard.clear()
        return pa.RecordBatch.from_pydict(columns)

    names = ["doc_id", "spans", "items"] + ["text"] * with_text
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            shard.add(batch.select(names).slice(chunk.low, chunk.high - chunk.low), chunk)
            if shard.size >= SHARD_WORDS or shard.docs >= SHARD_DOCS:
                yield flush()
    if shard.docs:
        yield flush()


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of each document that lie in an occurrence of a benchmark window.

    Words are runs of letters and digits, A-Z lower-cased. A window is ``window`` consecutive words of an item, or
    all of a shorter one. Documents are read in shards; each shard gets an FM-index over the words that can be part
    of a window, all windows are searched backwards at once, and occurrences are located by sampled suffixes and
    merged into spans. No text is shuffled.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``; other columns are ignored. A
    null text has no words; an item without words has no windows; an item without id is called ``null``; items with
    the same id are one. Repeated rows are treated each on its own; an empty benchmark hits nothing.

    Returns for every row of ``docs``: ``doc_id, n_words, n_hit``, ``items`` (sorted ids of the items with windows in
    it) and ``spans`` (hit words ``first`` to ``last``, and the code points from ``start`` to before ``end``).
    The benchmark goes to the tasks in blocks of about ``block_bytes`` of text.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    out = docs.select(
        F.col("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast(SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    of_id = docs.schema["doc_id"].dataType.simpleString()
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).collect()
        phrases = Phrases.of([r["name"] for r in rows], [r["text"] for r in rows], window)
        more = block < blocks - 1
        if phrases is None and (more or blocks > 1):
            continue
        if phrases is None:
            phrases = _NOTHING
        # Plain arrays: workers may not have this module.
        shared = spark.sparkContext.broadcast(tuple(vars(phrases).values()))
        schema = f"doc_id {of_id}, n_words long, spans {SPANS}, items array<string>" + ", text string" * more
        out = out.mapInArrow(lambda batches, shared=shared, more=more: _search(Phrases(*shared.value), more, batches), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans")


#: Searches for a word that no text has.
_NOTHING = Phrases(np.zeros(1, np.uint64), np.array([[0] * (WINDOW - 1) + [1]]), np.array([1]), np.array([0, 0]), np.zeros(0, np.int64), [])


def is_contaminated(n_words, n_hit):
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_spans(text, spans):
    """The text without its spans of code points."""
    kept = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"])).alias("out"), s["end"].alias("at")),
    )
    return F.concat(kept["out"], F.substr(text, kept["at"] + 1))
