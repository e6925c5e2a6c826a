"""Words of whole text columns as 64-bit hashes, computed on UTF-8 buffers without a loop over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; bounds the memory of the work arrays. A longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

#: Bytes of the longest word that the polynomial hash is used for. It is computed modulo a power of two, for which long words
#: of a known pattern (Thue-Morse words and their complements, from 1,024 letters) are equal; longer words get a BLAKE2 digest.
LONG_WORD = 256

_ODD = 0x9E3779B97F4A7C15  # multiplier of the polynomial hash; odd, so it has an inverse modulo 2**64
_INVERSE = pow(_ODD, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in any of the closed ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: ``[a-z0-9]`` and everything outside ASCII, after A-Z became a-z.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def _byte_values() -> np.ndarray:
    values = mixed((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_ODD))
    values[0x41:0x5B] = values[0x61:0x7B]
    return values


_BYTE = _byte_values()
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        base = np.full(size, _ODD, np.uint64), np.full(size, _INVERSE, np.uint64)
        for table in base:
            table[0] = 1
        _powers = np.cumprod(base[0], dtype=np.uint64), np.cumprod(base[1], dtype=np.uint64)
    return _powers


class Words(NamedTuple):
    """The words of some texts, one after the other."""

    hashes: np.ndarray  # of each word, A-Z taken as a-z
    starts: np.ndarray  # first byte of each word in the chunk
    ends: np.ndarray
    first: np.ndarray  # of each text, its first word; one entry more than texts


class Chunk(NamedTuple):
    low: int  # first row
    high: int
    data: np.ndarray  # UTF-8 bytes of the rows' texts
    bounds: np.ndarray  # of each row, its first byte; one entry more than rows


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of a text column in chunks of about ``size`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield Chunk(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def words(chunk: Chunk, letters: np.ndarray) -> Words:
    """Maximal runs of ``letters`` bytes within each text of the chunk."""
    data, bounds = chunk.data, chunk.bounds
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(bounds), np.int64))
    inside = letters[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < n]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    stops[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], dtype=np.uint64, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        # lower() of bytes changes A-Z alone.
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes().lower(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds))


def hash_words(texts: list[str], letters: np.ndarray) -> list[np.ndarray]:
    """Word hashes of a few texts."""
    out: list[np.ndarray] = []
    for chunk in chunks(pa.array(texts, pa.string())):
        found = words(chunk, letters)
        out += [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    return out


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for every run of ``n`` words; entry i starts at word i."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(_ODD) + hashes[k : len(hashes) - n + 1 + k])
    return out
