"""Vectorised word scanning of Arrow text columns, used inside tasks.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D. A batch is scanned in
slices of whole documents, so memory follows the slice (or one long document),
not the batch. Hashes are 64-bit and depend on the word's bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
SLICE_DOCS = 1 << 13
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _numbers(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_EXACT = _numbers(11, 256)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_PLACES = _numbers(23, 256)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for places 0 to n."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"], _powers["down"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


class Scan:
    """Words of consecutive documents. `first` is the first document's row in the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, separator: np.ndarray = _SEPARATOR):
        self.first, self.docs = first, len(offsets) - 1
        self.data, self.offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        size = len(self.data)
        self.word_byte = ~separator[self.data]
        begins = np.zeros(size + 1, bool)
        begins[self.offsets] = True
        before = np.zeros(size, bool)
        before[1:] = self.word_byte[:-1]
        after = np.zeros(size, bool)
        after[:-1] = self.word_byte[1:]
        self.starts = np.flatnonzero(self.word_byte & (~before | begins[:size]))
        self.ends = np.flatnonzero(self.word_byte & (~after | begins[1:])) + 1
        #: Document i has the words bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.n_words = np.diff(self.bounds)

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.n_words)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A hash of the bytes of each span, with A-Z lower-cased on demand."""
        up, down = _power(len(self.data))
        total = np.zeros(len(self.data) + 1, U64)
        np.cumsum((_LOWER if lower else _EXACT)[self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * U64(_BASE))

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, lower)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flagged bytes each document has."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.offsets])


def scans(column: pa.Array, limit: int = SLICE_BYTES, separator: np.ndarray = _SEPARATOR) -> Iterator[Scan]:
    data, offsets = text_buffers(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, low + SLICE_DOCS)
        yield Scan(data, offsets[low : high + 1], low, separator)
        low = high


def grams(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of n consecutive words each, n to 64 (across document borders too: see `inside`)."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    total = np.full(len(hashes) - n + 1, n, U64)
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * _PLACES[64 * seed + i]
    return mix(total)


def inside(bounds: np.ndarray, n: int) -> np.ndarray:
    """Places of the n-word windows that lie inside one document."""
    count = np.maximum(np.diff(bounds) - n + 1, 0)
    return np.repeat(bounds[:-1], count) + ranges(count)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 to counts[0] - 1, 0 to counts[1] - 1, and so on."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs at least twice."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out
