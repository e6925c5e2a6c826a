"""A quality score from statistics of the text: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.words import NOT_SPACE, Chunk, byte_class, chunks, shingles, words
from tillflow.session import written

#: Bins of raw scores that the calibration sees.
BINS = 2000

_CLASSES = {
    "upper": byte_class((0x41, 0x5A)),
    "lower": byte_class((0x61, 0x7A)),
    "digit": byte_class((0x30, 0x39)),
    "space": ~NOT_SPACE,
    "outside_ascii": byte_class((0x80, 0xFF)),
    "stops": byte_class(*((ord(c), ord(c)) for c in ".,;:?")),
    "quotes": byte_class(*((ord(c), ord(c)) for c in "'\"()-")),
    "shouts": byte_class((ord("!"), ord("!"))),
    "bars": byte_class((ord("|"), ord("|"))),
}
_SYMBOLS = ~np.logical_or.reduce(list(_CLASSES.values()))
_LINES = ~byte_class((0x0A, 0x0A))
_TEXT_END = byte_class(*((ord(c), ord(c)) for c in ".!?\"')"))

STATISTICS = [
    *(f"share_{name}" for name in _CLASSES), "share_symbols", "log_bytes", "log_words", "word_length", "word_spread",
    "distinct_words", "distinct_trigrams", "upper_words", "log_lines", "words_per_line", "distinct_lines", "ended_lines",
    "repeated_words", "log_repeated_words",
]


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Different values of each document."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n)


def statistics(chunk: Chunk) -> np.ndarray:
    """One row for each text, one column for each of ``STATISTICS``; all zero for an empty text."""
    data, n = chunk.data, len(chunk.bounds) - 1
    sizes = np.diff(chunk.bounds)
    per_byte = np.maximum(sizes, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(mask[data])])
        return np.diff(before[chunk.bounds]) / per_byte

    found = words(chunk, NOT_SPACE)
    n_words = np.diff(found.first)
    doc = np.repeat(np.arange(n), n_words)
    per_word = np.maximum(n_words, 1)
    lengths = (found.ends - found.starts).astype(np.float64)
    mean = np.bincount(doc, lengths, n) / per_word
    spread = np.sqrt(np.maximum(np.bincount(doc, lengths**2, n) / per_word - mean**2, 0))
    runs = shingles(found.hashes, 3)
    whole = doc[: len(runs)] == doc[2:] if len(doc) > 2 else np.zeros(0, bool)
    upper = _CLASSES["upper"][data[found.starts]] & _CLASSES["upper"][data[np.minimum(found.starts + 1, len(data) - 1)]] & (lengths > 1) if len(data) else np.zeros(0, bool)
    lines = words(chunk, _LINES)
    n_lines = np.diff(lines.first)
    of_line = np.repeat(np.arange(n), n_lines)
    ended = _TEXT_END[data[lines.ends - 1]] if len(data) else np.zeros(0, bool)
    per_line = np.maximum(n_lines, 1)
    again = np.bincount(doc[1:][(found.hashes[1:] == found.hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    return np.stack(
        [
            *(share(mask) for mask in _CLASSES.values()),
            share(_SYMBOLS),
            np.log1p(sizes),
            np.log1p(n_words),
            mean,
            spread,
            _distinct(found.hashes, doc, n) / per_word,
            _distinct(runs[whole], doc[: len(runs)][whole], n) / np.maximum(n_words - 2, 1),
            np.bincount(doc, upper, n) / per_word,
            np.log1p(n_lines),
            np.log1p(n_words / per_line),
            _distinct(lines.hashes, of_line, n) / per_line,
            np.bincount(of_line, ended, n) / per_line,
            again / per_word,
            np.log1p(again),
        ],
        axis=1,
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            rows = statistics(chunk)
            part = batch.drop_columns(["text"]).slice(chunk.low, chunk.high - chunk.low)
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(rows[:, k]) for k in range(rows.shape[1]))], [*part.schema.names, *STATISTICS])


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of the text of every row. Nothing is shuffled."""
    of_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_describe, f"doc_id {of_id}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Classifier:
    """Everything a score needs: the scaling, the random features, the weights and the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # raw scores, increasing
    calibrated: np.ndarray  # what they are worth, never decreasing

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Random Fourier features, whose products approximate a Gaussian kernel, and a constant."""
        scaled = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.cos(scaled @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(rows), 1))], axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(rows) @ self.weights, self.raw, self.calibrated), 0, 1)


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(s).to_numpy() for s in STATISTICS], axis=1)


def _isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest sequence that never decreases (pool adjacent violators)."""
    pools: list[list[float]] = []  # mean, weight, members
    for value, weight in zip(values, weights, strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            u = pools[-1]
            pools[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def train(labelled: DataFrame, features: int = 256, width: float = 0.15, ridge: float = 1e-3, seed: int = 11) -> Classifier:
    """Fits a classifier to all rows of ``labelled``: the statistics and ``label`` (0 or 1).

    Every task sums the normal equations of its rows; the sums of ``(features + 1)²`` cells come to the driver, which
    solves them. Raw scores of the same rows are counted in ``BINS`` bins for the calibration. ``labelled`` is
    read three times. Without rows, every score is one half.
    """
    stats = [f(s).alias(f"{n}_{s}") for s in STATISTICS for n, f in (("mean", F.avg), ("scale", F.stddev_pop))]
    row = labelled.agg(*stats).first()
    mean = np.array([row[f"mean_{s}"] or 0.0 for s in STATISTICS])
    scale = np.array([row[f"scale_{s}"] or 0.0 for s in STATISTICS])
    random = np.random.Generator(np.random.PCG64(seed))
    directions = random.normal(0, np.sqrt(2 * width), (len(STATISTICS), features))
    phases = random.uniform(0, 2 * np.pi, features)
    size = features + 1
    start = Classifier(mean, np.where(scale > 1e-9, scale, 1.0), directions, phases, np.zeros(size), np.zeros(1), np.full(1, 0.5))
    upper = np.triu_indices(size)
    cells = len(upper[0])
    values = tuple(vars(start).values())

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, left, right, n = Classifier(*values), np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            z = model.features(_table(batch))
            left += z.T @ z
            right += z.T @ batch.column("label").to_numpy()
            n += len(z)
        if n:
            sums = np.concatenate([left[np.triu_indices(size)], right, [n]])
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(sums))), "value": pa.array(sums)})

    sums = labelled.mapInArrow(equations, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    if not len(sums):
        return start
    flat = np.zeros(cells + size + 1)
    flat[sums["cell"]] = sums["value"]
    left = np.zeros((size, size))
    left[upper] = flat[:cells]
    left = left + left.T - np.diag(np.diag(left))
    n = flat[-1]
    weights = np.linalg.solve(left / n + ridge * np.diag([*np.ones(features), 0.0]) + 1e-12 * np.eye(size), flat[cells:-1] / n)
    fitted = Classifier(*values[:4], weights, *values[5:])
    fitted_values = tuple(vars(fitted).values())

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, n, ones = Classifier(*fitted_values), np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            raw = model.features(_table(batch)) @ model.weights
            at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            ones += np.bincount(at, batch.column("label").to_numpy(), BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(at, pa.int64()), "n": pa.array(n[at]), "ones": pa.array(ones[at])})

    counts = labelled.mapInArrow(binned, "bin long, n double, ones double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    counts = counts.orderBy("bin").toPandas()
    centres = (counts["bin"].to_numpy() + 0.5) / BINS * 2 - 0.5
    return Classifier(*fitted_values[:5], centres, _isotonic((counts["ones"] / counts["n"]).to_numpy(), counts["n"].to_numpy()))


def scored(stats: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id, score`` of every row of ``described()``."""
    of_id = stats.schema["doc_id"].dataType.simpleString()
    shared = stats.sparkSession.sparkContext.broadcast(tuple(vars(classifier).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(model.score(_table(batch)), pa.float64())})

    return stats.mapInArrow(run, f"doc_id {of_id}, score double")


def score_quality(docs: DataFrame, labels: DataFrame, may_learn, **options) -> tuple[DataFrame, Classifier]:
    """Scores every row of ``docs`` after learning from the labelled rows for which ``may_learn`` (a condition on
    ``doc_id``) holds.

    ``labels`` has ``doc_id`` and ``quality``; rows with a null in either are left out, and several labels of one id
    count with their mean. A null text counts as empty, and empty texts get a score too. Rows that repeat an id are
    scored each on its own. Other columns are ignored. Only statistics and labels are joined, never texts.
    """
    stats = written(described(docs))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    labelled = written(stats.join(known.where(may_learn), "doc_id").select("label", *STATISTICS))
    classifier = train(labelled, **options)
    return scored(stats, classifier), classifier
