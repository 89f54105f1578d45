"""Arrow text columns as flat NumPy buffers, and hashes over all their positions at once.

``mapInArrow`` hands a text column over as one UTF-8 buffer with offsets, so a whole
batch of documents is hashed with a few array passes and without a Python object per
document.  Work arrays stay small: batches are cut into ranges of at most ``LIMIT`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

LIMIT = 1 << 20

_MASK32 = np.uint64(32)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).fill_null("")
    else:
        column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_ranges(offsets: np.ndarray, limit: int = LIMIT) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that what is copied from one is small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _MASK32)
    h = h * _MIX1
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX2
    return h ^ (h >> _MASK32)


class Rolling:
    """Polynomial hashes modulo 2^64 of any span of a symbol sequence, from prefix sums."""

    def __init__(self, seed: int, longest: int) -> None:
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 62, dtype=np.int64)) * 8 + 5
        self.table = rng.integers(1 << 63, size=256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self._base = base % (1 << 64)
        self._inverse = pow(self._base, -1, 1 << 64)
        self._up, self._down = self._powers(self._base, longest + 1), self._powers(self._inverse, longest + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    def _reach(self, n: int) -> None:
        if n >= len(self._up):
            self._up = self._powers(self._base, 2 * n)
            self._down = self._powers(self._inverse, 2 * n)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """Prefix sums over bytes (through the symbol table) or over given 64-bit values."""
        self._reach(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        values = self.table[symbols] if symbols.dtype == np.uint8 else symbols
        np.cumsum(values * self._up[: len(symbols)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self._down[start]

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hash of every span of ``k`` symbols."""
        return (prefix[k:] - prefix[:-k]) * self._down[: len(prefix) - k]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width``, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """ASCII-white-space words of a buffer of documents: places, 64-bit hashes, words per document.

    A-Z is lower-cased; words never cross documents.
    """

    def __init__(self, rolling: Rolling, data: np.ndarray, offsets: np.ndarray) -> None:
        low = _LOWER[data]
        inside = ~_SPACE[data]
        n = len(data)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        if n:
            last[:-1] &= ~inside[1:]
            edges = offsets[(offsets > 0) & (offsets < n)]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.hash = mix(rolling.span(rolling.prefix(low), self.start, self.end) + (self.end - self.start).astype(np.uint64))
        #: words of document i are [bounds[i], bounds[i + 1])
        self.bounds = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes, the higher of which are nearly all zeros, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(body: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
