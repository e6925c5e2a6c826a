"""SentencePiece encoding and decoding with a given model, sharing work between words with a common prefix."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a space in pieces.
MARK = "▁"
#: A task keeps the encodings of about so many words that come again, and of as many that came before them.
CACHED_WORDS = 200_000
#: Pairs of pieces for which a task remembers whether they can be neighbours.
KNOWN_PAIRS = 1 << 20
#: Texts whose distinct words are put into one trie: so many characters.
BLOCK_CHARS = 4 << 20

_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class PieceModel:
    """Ordinary pieces with their ids and scores, and the ids of the 256 bytes (none: unknown characters get ``unknown``)."""

    pieces: dict[str, int]
    scores: dict[str, float]
    bytes_from: int | None
    unknown: int
    merges: bool  # pieces are joined in the order of their scores; else the best sum of scores wins

    @staticmethod
    def load(path: str) -> PieceModel:
        """Reads a model file on the driver."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("only models that leave texts as they are and mark their beginning")
        kinds = type(model.pieces[0])
        ordinary = [(i, p) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("only models without user-defined pieces")
        if any(MARK in p.piece.lstrip(MARK) for _, p in ordinary):
            raise ValueError("only models whose pieces have marks in front")
        bytes_from = next((i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE), None)
        return PieceModel(
            {p.piece: i for i, p in ordinary},
            {p.piece: p.score for _, p in ordinary},
            bytes_from,
            next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN),
            model.trainer_spec.model_type == model.trainer_spec.BPE,
        )


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Encoder:
    """Encodes marked words in sorted order: a depth-first walk of the trie of the words.

    For every prefix on the path to the current word it keeps the last piece of the prefix's best segmentation and
    its state: the longest end of the prefix with which a piece begins. A state knows all pieces that end there, so a
    character costs one step and not one for each piece that has begun. The next word starts from the states of the
    prefix it shares with this one.

    With scores that are summed (unigram models), the best segmentation is Viterbi's. With merges, every prefix has
    one survivor: the segmentation in which no two neighbours would have been merged across their border. Whether two
    pieces can be neighbours is found by merging just the two, and remembered.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.beginnings = {piece[:i] for piece in model.pieces for i in range(1, len(piece) + 1)}
        self.far = min(model.scores.values(), default=0.0) - 10
        self.neighbours: dict[tuple, bool] = {}
        #: The text of each state, the pieces that end there (longest first: length, piece, ids, score) and the states
        #: that characters lead to, as far as they are known. State 0 is empty.
        self.texts, self.ends, self.steps = [""], [()], [{}]
        self.states = {"": 0}

    def _step(self, state: int, c: str) -> int:
        text = self.texts[state] + c
        while text and text not in self.beginnings:
            text = text[1:]
        after = self.states.get(text)
        if after is None:
            after = self.states[text] = len(self.texts)
            pieces, scores = self.model.pieces, self.model.scores
            found = (text[i:] for i in range(len(text)))
            self.texts.append(text)
            self.ends.append(tuple((len(e), e, _packed([pieces[e]]), scores[e]) for e in found if e in pieces))
            self.steps.append({})
        # Characters with which no piece begins are not remembered: there may be any number.
        if after or c in self.beginnings:
            self.steps[state][c] = after
        return after

    def _merged(self, symbols: list[str]) -> list[str]:
        """Joins the two neighbours with the best score, the leftmost of equals, as long as any can be joined."""
        score, none = self.model.scores.get, float("-inf")
        pairs = [score(a + b, none) for a, b in pairwise(symbols)]
        while pairs and (best := max(pairs)) > none:
            at = pairs.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            for i in (at - 1, at):
                if 0 <= i < len(pairs):
                    pairs[i] = score(symbols[i] + symbols[i + 1], none)
        return symbols

    def _can_follow(self, before: str | None, piece: str) -> bool:
        key = (before, piece)
        known = self.neighbours.get(key)
        if known is None:
            text = (before or "") + piece
            known = self._merged(list(text)) == ([before, piece] if before else [piece])
            if len(self.neighbours) >= KNOWN_PAIRS:
                self.neighbours.clear()
            self.neighbours[key] = known
        return known

    def _unknown(self, c: str) -> bytes:
        if self.model.bytes_from is None:
            return _packed([self.model.unknown])
        return _packed([self.model.bytes_from + b for b in c.encode("utf-8")])

    def encode(self, words: Iterable[str]) -> Iterator[tuple[int, ...]]:
        """Ids of each word; ``words`` are sorted and different."""
        for ids in self.packed(words):
            yield tuple(memoryview(ids).cast("i"))

    def packed(self, words: Iterable[str]) -> Iterator[bytes]:
        """Ids of each word, as packed 32-bit numbers; ``words`` are sorted and different."""
        merges, all_steps, all_ends, neighbours = self.model.merges, self.steps, self.ends, self.neighbours
        # For the prefix of each length: where its last piece starts, the piece and ids, the score, and the state.
        starts, lasts, ids, scores, states = [0], [None], [b""], [0.0], [0]
        previous = ""
        for word in words:
            shared = 0
            for a, b in zip(previous, word):  # noqa: B905
                if a != b:
                    break
                shared += 1
            for kept in (starts, lasts, ids, scores, states):
                del kept[shared + 1 :]
            state = states[shared]
            for at in range(shared, len(word)):
                c = word[at]
                after = all_steps[state].get(c)
                state = self._step(state, c) if after is None else after
                chosen, best = None, None
                if merges:
                    for end in all_ends[state]:
                        before = lasts[at + 1 - end[0]]
                        fits = neighbours.get((before, end[1]))
                        if self._can_follow(before, end[1]) if fits is None else fits:
                            chosen, best = end, 0.0
                            break
                else:
                    for end in all_ends[state]:
                        score = scores[at + 1 - end[0]] + end[3]
                        if best is None or score > best:
                            chosen, best = end, score
                states.append(state)
                if chosen is None:
                    starts.append(at)
                    lasts.append(None)
                    ids.append(self._unknown(c))
                    scores.append(scores[at] + self.far)
                else:
                    starts.append(at + 1 - chosen[0])
                    lasts.append(chosen[1])
                    ids.append(chosen[2])
                    scores.append(best)
            previous = word
            at, out = len(word), []
            while at:
                out.append(ids[at])
                at = starts[at]
            out.reverse()
            yield b"".join(out)


class Decoder:
    """Ids to text: pieces are joined, runs of byte ids are read as UTF-8, marks become spaces."""

    def __init__(self, model: PieceModel):
        size = max([model.unknown, *model.pieces.values(), (model.bytes_from or 0) + 255]) + 1
        self.raw = [b""] * size
        for piece, number in model.pieces.items():
            self.raw[number] = piece.replace(MARK, " ").encode("utf-8")
        if model.bytes_from is not None:
            for b in range(256):
                self.raw[model.bytes_from + b] = bytes([b])
        self.raw[model.unknown] = " ⁇ ".encode()

    def decode(self, ids: Iterable[int]) -> str:
        raw = self.raw
        out = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, chars in enumerate(pc.utf8_length(texts).to_pylist()):
        size += chars or 0
        if size >= BLOCK_CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _numbered(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words, sorted; the place among them of every word of the texts; and the words of each text. Of a word
    that comes again only its number is held."""
    numbers: defaultdict[str, int] = defaultdict(count().__next__)
    found = []
    for t in texts:
        split = _WORDS.findall(MARK + t.replace(" ", MARK)) if t else []
        found.append(np.fromiter(map(numbers.__getitem__, split), np.int32, len(split)))
    words = sorted(numbers)
    place = np.zeros(len(words), np.int64)
    place[np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
    return words, place[np.concatenate(found)], np.array([len(x) for x in found])


class _Known:
    """Encodings of words that come again: those used since the last change of generation, and those of the generation
    before. The few that decoding doesn't give back are listed."""

    def __init__(self, model: PieceModel):
        self.encoder, self.decoder = Encoder(model), Decoder(model)
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.lost: set[str] = set()

    def of(self, words: list[str]) -> list[bytes]:
        """For different words, sorted."""
        if len(self.now) > CACHED_WORDS:
            self.before, self.now = self.now, {}
            self.lost.intersection_update(self.before)
        now, before = self.now, self.before
        fresh = []
        for w in words:
            if w not in now:
                known = before.get(w)
                if known is None:
                    fresh.append(w)
                else:
                    now[w] = known
        raw = self.decoder.raw
        for w, ids in zip(fresh, self.encoder.packed(fresh), strict=True):
            now[w] = ids
            if b"".join([raw[i] for i in memoryview(ids).cast("i")]) != w.replace(MARK, " ").encode():
                self.lost.add(w)
        return [now[w] for w in words]


#: Of the model that this Python worker used last; its next task goes on with it.
_LAST: dict[str, _Known] = {}


def _known(name: str, model: tuple) -> _Known:
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = _Known(PieceModel(*model))
    return _LAST[name]


def _encode(known: _Known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in _blocks(batch.column("text")):
            texts = batch.column("text").slice(low, high - low).to_pylist()
            words, word, of_text = _numbered(texts)
            encoded = known.of(words)
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
            flat = np.frombuffer(b"".join(encoded), np.int32)
            first = np.concatenate([[0], np.cumsum(lengths)])
            # Where each document's ids come from: runs of the flat array, word by word.
            number = lengths[word]
            until = np.cumsum(number)
            ids = flat[np.repeat(first[word] - (until - number), number) + np.arange(int(until[-1]) if len(until) else 0)]
            words_until = np.concatenate([[0], np.cumsum(of_text)])
            offsets = np.concatenate([[0], until])[words_until].astype(np.int32)
            # A text whose words all come back comes back, unless it holds the mark itself. Others are decoded.
            lost = np.fromiter(map(known.lost.__contains__, words), np.int64, len(words))
            lost = np.diff(np.concatenate([[0], np.cumsum(lost[word])])[words_until])
            exact = [
                t is None or (not n and MARK not in t) or known.decoder.decode(ids[a:b].tolist()) == t
                for t, n, a, b in zip(texts, lost.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            ]
            rest = batch.drop_columns(["text"]).slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())), pa.array(exact, pa.bool_())],
                [*rest.schema.names, "ids", "exact"],
            )


def encode(docs: DataFrame, model: PieceModel) -> DataFrame:
    """``doc_id, ids, exact`` for every row: the ids of the whole text, and whether decoding them gives it back.

    Spaces are marked, and a mark is put before the text; a word is a run of marks and what follows up to the next
    mark, since no piece goes on past it. Blocks of texts are encoded by their distinct words, sorted. Characters
    that the model lacks become its byte ids. ``exact`` is false only for texts that hold the mark itself, which
    decodes to a space, or characters that the model can't give back. A null or empty text has no ids and is exact;
    repeated rows are treated each on its own; other columns are ignored. Nothing is shuffled.
    """
    of_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encode(_known(name, shared.value), batches)

    return rows.mapInArrow(run, f"doc_id {of_id}, ids array<int>, exact boolean")


def decode(tokens: DataFrame, model: PieceModel) -> DataFrame:
    """``doc_id, text`` of every row of ``tokens`` (``doc_id, ids``); null ids give a null text, no ids an empty one."""
    of_id = tokens.schema["doc_id"].dataType.simpleString()
    shared = tokens.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(PieceModel(*shared.value))
        for batch in batches:
            texts = [None if ids is None else decoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {of_id}, text string")
