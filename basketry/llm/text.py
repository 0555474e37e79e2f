"""Bytes, words and shingles of Arrow text columns as numpy arrays.

A word is a maximal run of ASCII letters and digits and of characters beyond ASCII, with A-Z
lower-cased.  Every byte of a character beyond ASCII is above 0x7F, so words can be found on
UTF-8 bytes without decoding them.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # a worker takes some 50 times that at once
_U = np.uint64
MULTIPLIER = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(_U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64; sent to executors empty."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grown = np.ones((2, max(n, SLICE_BYTES + 1)), _U)
            grown[0, 1:], grown[1, 1:] = MULTIPLIER, _INVERSE
            self.up, self.down = np.cumprod(grown, axis=1)
        return self.up, self.down


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser of shifts and odd multipliers)."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after another, and offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches to at most ``limit`` bytes of text, or one row; whole texts always."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = max(end, at + 1)
            part = offsets[at : end + 1]
            yield batch.slice(at, end - at), data[part[0] : part[-1]], part - part[0]
            at = end
        release()


@dataclass
class Words:
    """Words of several texts: 64-bit hashes, byte places, and the first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than texts: words of text i are first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each place on, and which of them lie in one text."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, _U), np.zeros(0, bool)
        h = self.hashes[: total - n + 1].copy()
        for k in range(1, n):
            h = h * MULTIPLIER + self.hashes[k : total - n + 1 + k]
        inside = np.ones(len(h), bool)
        for k in range(1, n):  # a window may not run over the first word of a later text
            cuts = self.first[1:-1] - k
            inside[cuts[(cuts >= 0) & (cuts < len(h))]] = False
        return mix(h), inside


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        zero = np.zeros(0, np.int64)
        return Words(np.zeros(0, _U), zero, zero, np.zeros(len(offsets), np.int64))
    low = LOWER[data]
    inside = _IN_WORD[low]
    cuts = offsets[:-1][offsets[:-1] < n]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = cuts[cuts > 0] - 1
    stops[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _POWERS.upto(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(_BYTE_CODE[low] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, from one running sum over all bytes."""
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def append_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with more columns; a column of the same name gives way."""
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def release() -> None:
    """Give freed memory back, which a reused worker would keep beside the next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def per_process(key: tuple, make: Callable):
    """A value made once in a Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_basketry_worker", types.ModuleType("_basketry_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
