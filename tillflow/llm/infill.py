"""Fill-in-the-middle: texts cut in three at hashed places and put together anew, and the way back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.runs import SLAB, runs
from tillflow.llm.words import NOT_SPACE, Chunk, chunks

#: What stands before each part of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = ["plain", "psm", "spm"]
#: Order in the output of the parts (prefix 0, middle 1, suffix 2) of each form but ``plain``.
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}

_MARKERS = np.frombuffer((PREFIX + MIDDLE + SUFFIX).encode(), np.uint8).reshape(3, 3)


def drawn(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 for a document: the first 8-digit groups of the SHA-256 of ``seed:doc_id``."""
    digest = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), "UTF-8"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    column = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return column.cast(pa.string())


def _scatter(data: np.ndarray, at: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    """``out[i + shift] = data[i]`` for every byte, where ``shift[k]`` holds from byte ``at[k]`` on.

    ``at`` ascends. The shift of each byte is the running sum of the differences that stand at the places where it
    changes, slab by slab with the sum carried on.
    """
    steps = np.diff(shift, prepend=0)
    carried = 0
    for low in range(0, len(data), SLAB):
        high = min(low + SLAB, len(data))
        a, b = np.searchsorted(at, [low, high])
        by_byte = np.zeros(high - low, np.int64)
        np.add.at(by_byte, at[a:b] - low, steps[a:b])  # parts may be empty, so that several steps fall on one byte
        by_byte[0] += carried
        np.cumsum(by_byte, out=by_byte)
        carried = int(by_byte[-1])
        out[np.arange(low, high) + by_byte] = data[low:high]


def _gather(data: np.ndarray, at: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` bytes ``data[i + shift]``, the inverse of :func:`_scatter`."""
    out = np.empty(n, np.uint8)
    steps = np.diff(shift, prepend=0)
    carried = 0
    for low in range(0, n, SLAB):
        high = min(low + SLAB, n)
        a, b = np.searchsorted(at, [low, high])
        by_byte = np.zeros(high - low, np.int64)
        np.add.at(by_byte, at[a:b] - low, steps[a:b])
        by_byte[0] += carried
        np.cumsum(by_byte, out=by_byte)
        carried = int(by_byte[-1])
        out[low:high] = data[np.arange(low, high) + by_byte]
    return out


def _code_points(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Code points between byte offsets that start characters."""
    at = np.sort(np.concatenate([low, high]))
    counts = np.zeros(len(at), np.int64)
    before = 0
    for start in range(0, len(data), SLAB):
        end = min(start + SLAB, len(data))
        sums = np.zeros(end - start + 1, np.int64)
        np.cumsum((data[start:end] & 0xC0) != 0x80, out=sums[1:])
        a, b = np.searchsorted(at, start, "left"), np.searchsorted(at, end, "right")
        counts[a:b] = before + sums[at[a:b] - start]
        before += int(sums[-1])
    return counts[np.searchsorted(at, high)] - counts[np.searchsorted(at, low)]


def _layout(starts: np.ndarray, order: np.ndarray, lengths: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of three parts: where each part begins in its output, after its marker, and the output's size.

    ``order[r]`` lists the parts as they follow in the output; ``marks[r]`` is the size of a marker, 0 for none;
    ``starts[r]`` is the output's first byte.
    """
    follow = np.take_along_axis(lengths, order, 1)
    after = np.cumsum(follow + marks[:, None], axis=1)
    begins = np.empty_like(lengths)
    np.put_along_axis(begins, order, starts[:, None] + after - follow, 1)
    return begins, after[:, -1]


def _orders(forms: np.ndarray) -> np.ndarray:
    return np.array([(0, 1, 2), ORDER["psm"], ORDER["spm"]])[forms]


def _cut(chunk: Chunk, form: np.ndarray, first: np.ndarray, second: np.ndarray) -> dict[str, pa.Array]:
    """Units, parts and outputs of the rows of a chunk."""
    data, low, high = chunk.data, chunk.bounds[:-1], chunk.bounds[1:]
    _, ends = runs(data, chunk.bounds, NOT_SPACE)
    before = np.searchsorted(ends, low, "right")  # an end at the row's first byte is the last row's
    solid = np.searchsorted(ends, high, "right") - before
    # White space after the last word, or all of a blank text, is a unit of its own.
    last = np.where(solid > 0, ends[np.maximum(before + solid, 1) - 1] if len(ends) else 0, low)
    n = solid + (last < high)
    two = np.sort(np.stack([first % (n + 1), second % (n + 1)], 1), axis=1)
    reach = np.append(ends, 0)[np.clip(before[:, None] + two - 1, 0, len(ends))]
    cuts = np.where(two == 0, low[:, None], np.where(two > solid[:, None], high[:, None], reach))

    plain = form == 0
    edges = np.concatenate([low[:, None], cuts, high[:, None]], axis=1)
    edges[plain, 1:3] = high[plain, None]
    lengths = np.diff(edges, axis=1)
    marks = np.where(plain, 0, 3)
    order = _orders(form)
    sizes = lengths.sum(axis=1) + 3 * marks
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    begins, _ = _layout(starts, order, lengths, marks)
    out = np.empty(int(sizes.sum()), np.uint8)
    _scatter(data, edges[:, :3].ravel(), (begins - edges[:, :3]).ravel(), out)
    places = begins[~plain] - 3
    for k in range(3):
        out[places + k] = _MARKERS[:, k]
    none = pa.array(plain)

    def of(a: np.ndarray, b: np.ndarray) -> pa.Array:
        return pc.if_else(none, pa.scalar(None, pa.int64()), pa.array(_code_points(data, a, b)))

    return {
        "n": pa.array(n.astype(np.int64)),
        "prefix_chars": of(edges[:, 0], edges[:, 1]),
        "middle_chars": of(edges[:, 1], edges[:, 2]),
        "output": _strings(out, sizes),
    }


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            rows = batch.slice(chunk.low, chunk.high - chunk.low)
            form, first, second = (rows.column(c).to_numpy() for c in ("form", "h1", "h2"))
            columns = {"doc_id": rows.column("doc_id"), "form": rows.column("form"), **_cut(chunk, form, first, second)}
            yield pa.RecordBatch.from_pydict({k: columns[k] for k in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")})


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """Training texts in which the middle comes last.

    A unit is a run of characters other than white space (``[\\x20\\x09-\\x0D]``) with all white space before it; what
    white space is left at the end is one more. Four numbers hashed from ``seed`` and ``doc_id`` decide: of ``n`` units
    the prefix ends after the smaller of the first two modulo ``n + 1``, the middle after the larger; ``rate`` of 100
    texts by the third are cut, of these ``spm_rate`` of 100 by the fourth in the form ``spm``. Output: of ``psm``
    ``<P>prefix<S>suffix<M>middle``, of ``spm`` ``<S>suffix<P>prefix<M>middle``, of ``plain`` the text. Texts that are
    null, empty, or contain a marker are ``plain``.

    Returns for every row ``doc_id, n, form, prefix_chars, middle_chars, output``; lengths are in code points, null for
    ``plain``. A null ``doc_id`` is hashed as an empty one; rows that share an id are cut by the same numbers; other
    columns are ignored; an empty table gives no rows.

    Rows stay in their partition. The cuts of a chunk of texts are scanned together, and every byte is moved once, by a
    shift that is the running sum of the differences at the cuts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h1, h2, h3, h4 = drawn(F.col("doc_id"), seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), 0).when(h4 % 100 < spm_rate, 2).otherwise(1)
    of_id = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2")).mapInArrow(
        _forward, f"doc_id {of_id}, n long, form int, prefix_chars long, middle_chars long, output string"
    )
    return found.withColumn("form", F.element_at(F.array(*map(F.lit, FORMS)), F.col("form") + 1))


def _uncut(chunk: Chunk, form: np.ndarray) -> pa.Array:
    """The texts of the rows of a chunk of outputs."""
    data, low, high = chunk.data, chunk.bounds[:-1], chunk.bounds[1:]
    cut = np.flatnonzero(form > 0)
    # Texts with a marker are plain, so that each of the others has each marker once, at one place for each part.
    of_part = np.zeros((len(cut), 3), np.int64)
    for part in range(3):
        at = _found(data, _MARKERS[part])
        row = np.searchsorted(low, at, "right") - 1
        keep = (form[row] > 0) & (at + 3 <= high[row])
        of_part[np.searchsorted(cut, row[keep]), part] = at[keep]
    order = _orders(form[cut])
    follow = np.take_along_axis(of_part, order, 1)
    stops = np.concatenate([follow[:, 1:], high[cut][:, None]], axis=1)
    lengths = np.empty_like(of_part)
    np.put_along_axis(lengths, order, stops - follow - 3, 1)
    sizes = high - low
    sizes[cut] -= 9
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # Parts of the texts in their order there, with what is to be added to reach them in the outputs.
    begins = np.repeat(starts[:, None], 3, axis=1)
    shift = np.repeat((low - starts)[:, None], 3, axis=1)
    begins[cut, 1] += lengths[:, 0]
    begins[cut, 2] += lengths[:, 0] + lengths[:, 1]
    shift[cut] = of_part + 3 - begins[cut]
    return _strings(_gather(data, begins.ravel(), shift.ravel(), int(sizes.sum())), sizes)


def _found(data: np.ndarray, marker: np.ndarray) -> np.ndarray:
    """Places of a marker of three bytes."""
    out = [np.zeros(0, np.int64)]
    for low in range(0, len(data) - 2, SLAB):
        piece = data[low : low + SLAB + 2]
        out.append(np.flatnonzero((piece[:-2] == marker[0]) & (piece[1:-1] == marker[1]) & (piece[2:] == marker[2])) + low)
    return np.concatenate(out)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("output")):
            rows = batch.slice(chunk.low, chunk.high - chunk.low)
            form = pc.index_in(rows.column("form"), pa.array(FORMS)).to_numpy()
            yield pa.RecordBatch.from_arrays([*rows.columns, _uncut(chunk, form)], [*rows.schema.names, "restored"])


def restore(found: DataFrame) -> DataFrame:
    """Adds ``restored``: the text, from ``output`` and ``form`` alone. Rows stay in their partition."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.mapInArrow(_backward, f"{columns}, restored string")
