"""Language of documents, and of spans within documents of mixed language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.words import Words, byte_class, chunks, words

#: Runs of these bytes are words: ASCII letters and everything outside ASCII.
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Byte trigrams share so many counters.
BUCKETS = 1 << 15

# The first code point of each range of scripts, and the script.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Indic"), (0x0E00, "Thai"), (0x0E80, "other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD800, "other"), (0xF900, "Han"), (0xFB00, "other"),
]
_SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_NUMBERS = np.array([_SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@dataclass(frozen=True)
class Model:
    """Log probabilities of trigram counters for each language, and the scripts each is written in."""

    languages: list[str]
    scores: np.ndarray  # BUCKETS x languages
    written_in: np.ndarray  # scripts x languages, true where a language is a candidate
    penalty: float


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    table[0x41:0x5B] += 32
    table[~LETTERS] = 0
    return table


_LOWER = _lower_table()


def _grams(data: np.ndarray) -> np.ndarray:
    """The counter of the byte trigram around each byte; what is no letter counts as one blank."""
    padded = np.zeros(len(data) + 2, np.uint32)
    padded[1:-1] = _LOWER[data]
    gram = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    return ((gram * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)


def _scripts(data: np.ndarray, found: Words) -> np.ndarray:
    """The script of each word, by its first character."""
    n = len(data)
    lead = data[found.starts].astype(np.int64)
    follow = [data[np.minimum(found.starts + k, n - 1)].astype(np.int64) & 0x3F for k in (1, 2)]
    point = np.where(lead < 0x80, lead, np.where(lead < 0xE0, ((lead & 0x1F) << 6) | follow[0], np.where(lead < 0xF0, ((lead & 0x0F) << 12) | (follow[0] << 6) | follow[1], 0x20000)))
    return _SCRIPT_NUMBERS[np.searchsorted(_SCRIPT_STARTS, point, "right") - 1]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language: how often each trigram counter and each script occurs."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for chunk in chunks(batch.column("text")):
            found = words(chunk, LETTERS)
            if not len(found.starts):
                continue
            inside = LETTERS[chunk.data]
            gram, script = _grams(chunk.data), _scripts(chunk.data, found)
            names, which = np.unique(langs[chunk.low : chunk.high].astype(str), return_inverse=True)
            of_byte = np.repeat(which, np.diff(chunk.bounds))[inside]
            of_word = np.repeat(which, np.diff(found.first))
            grams = np.bincount(of_byte * BUCKETS + gram[inside], minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            scripts = np.bincount(of_word * len(_SCRIPT_NAMES) + script, minlength=len(names) * len(_SCRIPT_NAMES)).reshape(len(names), -1)
            for i, name in enumerate(names):
                counted = np.concatenate([grams[i], scripts[i]])
                totals[name] = totals[name] + counted if name in totals else counted
    for name, counted in totals.items():
        at = np.flatnonzero(counted)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "feature": pa.array(at, pa.int64()), "n": pa.array(counted[at], pa.int64())})


def train(labelled: DataFrame, penalty: float = 25.0, smoothing: float = 0.5, rare_script: float = 0.01) -> Model:
    """A model from all rows of ``labelled`` (``text``, ``lang``); rows without a language or text are left out.

    Every task counts byte trigrams into 32,768 counters for each language; the sums come to the driver, so its
    memory is bounded by the number of languages. ``penalty`` is what a change of language within a text costs, in
    nats. A language is a candidate for words of a script if that script has a share of ``rare_script`` of its words.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(_counts, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS + len(_SCRIPT_NAMES)))
    counts[np.searchsorted(languages, sums["lang"].to_numpy(str)) if languages else [], sums["feature"]] = sums["n"]
    grams, scripts = counts[:, :BUCKETS] + smoothing, counts[:, BUCKETS:]
    scores = np.log(grams / grams.sum(axis=1, keepdims=True)).T
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, np.ascontiguousarray(scores, np.float32), (share >= rare_script).T, penalty)


def any_language() -> Model:
    """A model of one language without a name, which is that of every text with a letter."""
    return Model([""], np.zeros((BUCKETS, 1), np.float32), np.ones((len(_SCRIPT_NAMES), 1), bool), 0.0)


def _word_scores(model: Model, data: np.ndarray, found: Words) -> np.ndarray:
    """Words by languages: the log probability of the word's trigrams; other scripts' languages are far behind."""
    gram = _grams(data)
    out = np.empty((len(found.starts), len(model.languages)), np.float32)
    # Words are runs of bytes, so the sums over words are differences of running sums.
    for k in range(len(model.languages)):
        sums = np.concatenate([[0.0], np.cumsum(model.scores[:, k][gram], dtype=np.float64)])
        out[:, k] = sums[found.ends] - sums[found.starts]
    candidates = model.written_in[_scripts(data, found)]
    narrowed = candidates.any(axis=1)
    out[narrowed] -= np.where(candidates[narrowed], 0, 4 * model.penalty).astype(np.float32)
    return out


def _best_path(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The language of every word on the best path of its text; all texts of a chunk advance together."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = first[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")  # texts with a word at each step
    kind = np.min_scalar_type(scores.shape[1])  # the smallest numbers that tell all languages apart
    before = np.empty(scores.shape, kind)  # the language of the word before, if this one has the language
    names = np.arange(scores.shape[1], dtype=kind)
    value = np.zeros((len(starts), scores.shape[1]), np.float32)
    last = np.zeros(len(starts), np.int64)
    for step in range(steps):
        n = live[step]
        at = starts[:n] + step
        value = value[:n]
        best = value.argmax(axis=1)
        value = value - value[np.arange(n), best][:, None]
        changes = value < -penalty
        before[at] = np.where(changes, best[:, None].astype(kind), names)
        value = np.maximum(value, -penalty) + scores[at]
        ongoing = live[step + 1] if step + 1 < steps else 0
        last[ongoing:n] = value[ongoing:].argmax(axis=1)  # where the paths of texts that end here end
    path = np.empty(len(scores), kind)
    for step in range(steps - 1, -1, -1):
        n = live[step]
        at = starts[:n] + step
        path[at] = last[:n]
        last[:n] = before[at, last[:n]]
    return path


def _label(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*model.languages, "und"]
    n_lang = len(model.languages)
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            found = words(chunk, LETTERS)
            n = chunk.high - chunk.low
            pred, score = np.full(n, n_lang), np.zeros(n)
            spans: list[list[dict]] = [[] for _ in range(n)]
            if n_lang and len(found.starts):
                path = _best_path(_word_scores(model, chunk.data, found), found.first, model.penalty)
                doc = np.repeat(np.arange(n), np.diff(found.first))
                weight = np.bincount(doc * n_lang + path, found.ends - found.starts, n * n_lang).reshape(n, n_lang)
                total = weight.sum(axis=1)
                ascii_letters = np.concatenate([[0], np.cumsum(LETTERS[chunk.data] & (chunk.data < 0x80))])
                has = np.diff(ascii_letters[chunk.bounds]) > 0
                for i in np.flatnonzero(~has & (total > 0)):  # only characters outside ASCII: are they letters?
                    has[i] = any(c.isalpha() for c in bytes(chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]).decode("utf-8", "replace"))
                pred = np.where(has, weight.argmax(axis=1), n_lang)
                score = np.where(has, weight.max(axis=1) / np.maximum(total, 1), 0.0)
                new = np.ones(len(path), bool)
                new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                until = np.append(at[1:], len(path)) - 1
                for a, b, d in zip(at.tolist(), until.tolist(), doc[at].tolist(), strict=True):
                    if has[d]:
                        low = int(found.first[d])
                        spans[d].append({"lang": names[path[a]], "first": a - low, "last": b - low})
            rest = batch.drop_columns(["text"]).slice(chunk.low, n)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([names[k] for k in pred], pa.string()), pa.array(score, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())])))],
                [*rest.schema.names, "lang_pred", "score", "spans"],
            )


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for every row of ``docs``.

    Words are runs of letters. The script of a word narrows the languages it can be in; a Viterbi pass over the
    words' scores labels spans, paying for every change of language. The prediction is the language with the most
    letters, the score their share. A text that is null or has no letter is ``und`` with score 0 and no spans, and
    so is everything if the model knows no language. Other columns are ignored; repeated rows are treated each on
    its own. Nothing is shuffled.
    """
    of_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {of_id}, lang_pred string, score double, spans array<struct<lang:string,first:int,last:int>>"
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    return rows.mapInArrow(lambda batches: _label(Model(*shared.value), batches), schema)


def remainder(doc_id: Column, modulus: int) -> Column:
    """Which part of a split by id a row is in: crc32 of the id as text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))
