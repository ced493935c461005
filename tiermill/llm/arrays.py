"""Numpy views of Arrow text columns: slices of bounded size, words, hashes and packed key arrays.

Workers see texts as one byte buffer with document offsets, so words and hashes of a whole slice are found by
a few array operations instead of a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard

from tiermill.llm.workers import let_go

SLICE_BYTES = 1 << 20
#: Longer strings are hashed in blocks of so many bytes: the polynomial alone is equal for certain long strings.
HASH_BLOCK = 64

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads differences over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the longest slice seen."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


class RollingHash:
    """64-bit hashes of arbitrary substrings of one buffer, each in constant time up to ``HASH_BLOCK`` bytes, else in time per block."""

    def __init__(self, data: np.ndarray):
        powers, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * powers[: len(data)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self._blocks(starts, np.minimum(ends, starts + HASH_BLOCK))
        long = np.flatnonzero(ends - starts > HASH_BLOCK)
        if not len(long):
            return out
        sizes = (ends - starts)[long]
        counts = -(-sizes // HASH_BLOCK)
        first = np.cumsum(counts) - counts
        place = np.arange(counts.sum()) - np.repeat(first, counts)
        begins = np.repeat(starts[long], counts) + place * HASH_BLOCK
        parts = self._blocks(begins, np.minimum(begins + HASH_BLOCK, np.repeat(ends[long], counts)))
        parts = mix(parts + (place + 1).astype(np.uint64) * np.uint64(_BASE))
        out[long] = mix(np.add.reduceat(parts, first) ^ sizes.astype(np.uint64))
        return out

    def _blocks(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes, by their start; at most a block."""
        count = max(0, len(self._sums) - width)
        if not count:
            return np.zeros(0, np.uint64)
        raw = (self._sums[width:] - self._sums[:count]) * self._inverse[:count]
        return mix(raw ^ np.uint64((width * 0xA24BAED4963EE407) & _MASK))


@dataclass
class Texts:
    """Some consecutive texts: their bytes and, for each text, where it begins (one more offset at the end)."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of rows of about ``size`` bytes; a longer text is a run of its own. NULL is empty."""
    let_go()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_binary()), np.int64
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield Texts(data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row], row)
        row = until


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words:
    """Words of a slice: byte ranges, and for each text the number of its first word (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def owners(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


def words(texts: Texts) -> Words:
    """Runs of bytes other than space and 0x09-0x0D; no word crosses texts."""
    size = len(texts.data)
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = ~_SPACE[texts.data]
    begins = inside[1:] & ~inside[:-1]
    stops = ~inside[1:] & inside[:-1]
    edges = texts.offsets[1:-1]
    edges = edges[inside[edges] & inside[edges + 1]]
    begins[edges] = True
    stops[edges] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def word_hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words of the lower-cased texts and a 64-bit hash of each."""
    found = words(texts)
    return found, RollingHash(lower(texts.data)).spans(found.starts, found.ends)


def pack(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte plane by byte plane, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed; small ones cost next to nothing."""
    planes = np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()
