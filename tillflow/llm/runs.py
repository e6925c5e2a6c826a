"""Runs of a class of bytes in the texts of a chunk, found slab by slab, so that the work arrays stay small."""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes that are looked at together; the work arrays have a few times that size, however long a text is.
SLAB = 1 << 20
#: Words up to this length share the steps of one checksum loop; each longer one is handed to zlib.
LOOP_BYTES = 48


def runs(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray]:
    """First byte, and the byte after the last, of every maximal run of ``inside`` bytes that lies within one row."""
    n = len(data)
    starts, ends = [], []
    before = False  # whether the byte before the slab is in a run
    for low in range(0, n, slab):
        high = min(low + slab, n)
        now = inside[data[low:high]]
        last = np.empty_like(now)
        last[0], last[1:] = before, now[:-1]
        edge = np.zeros(high - low, bool)
        edge[bounds[np.searchsorted(bounds, low) : np.searchsorted(bounds, high)] - low] = True
        starts.append(np.flatnonzero(now & (edge | ~last)) + low)
        ends.append(np.flatnonzero(last & (edge | ~now)) + low)
        before = bool(now[-1])
    if before:
        ends.append(np.array([n]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *ends])


def _crc_table() -> np.ndarray:
    """The table of the CRC-32 with the reversed polynomial 0xEDB88320, as zlib has it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run of bytes, a step for the next byte of all runs together."""
    lengths = ends - starts
    out = np.empty(len(starts), np.uint32)
    for i in np.flatnonzero(lengths > LOOP_BYTES).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    short = np.flatnonzero(lengths <= LOOP_BYTES)
    short = short[np.argsort(-lengths[short], kind="stable")]
    at, left = starts[short], lengths[short]
    crc = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k))  # runs of more than k bytes
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out[short] = ~crc
    return out
