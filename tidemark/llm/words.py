"""Words, word windows and their hashes for whole Arrow text columns, in numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  Hashes are
64-bit polynomials taken from prefix sums, so every window of a text costs a few
vector operations whatever its length; two different words, windows or lines meet
with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

PIECE = 1 << 20  # bytes hashed at a time
SLICE = 2 << 20  # bytes of text worked on at a time; one longer text is a slice of its own

_RANDOM = np.random.Generator(np.random.PCG64(20_240_601))
_BYTES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]  # A-Z hash as a-z
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, PIECE + 64)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * PIECE:
            _powers[base] = have
    return have[:n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading zero."""
    out = np.zeros(len(values) + 1, values.dtype if values.dtype == np.uint64 else np.int64)
    np.cumsum(values, out=out[1:])
    return out


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    """Hash of ``data[start:end]`` for ascending segments that do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        prefix = sums(table[data[low:high]] * powers(_BASE, high - low)[:-1])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (prefix[e] - prefix[s]) * powers(_INVERSE, high - low)[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive elements."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    prefix = sums(hashes * powers(_BASE, len(hashes))[:-1])
    return mix((prefix[size:] - prefix[:n]) * powers(_INVERSE, n)[:n])


@dataclass
class Words:
    """Words of the texts that lie in ``data`` one after another."""

    data: np.ndarray  # bytes
    offsets: np.ndarray  # of text i: offsets[i] to offsets[i + 1]
    starts: np.ndarray  # of every word, in bytes
    ends: np.ndarray
    first: np.ndarray  # words of text i: first[i] to first[i + 1]

    def hashes(self, fold: bool = False) -> np.ndarray:
        return segment_hashes(self.data, self.starts, self.ends, _FOLDED if fold else _BYTES)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, size: int) -> np.ndarray:
        """First words of the windows of ``size`` words that lie within one text."""
        counts = np.maximum(self.counts - size + 1, 0)
        shift = np.repeat(self.first[:-1] - sums(counts)[:-1], counts)
        return np.arange(len(shift)) + shift

    def per_text(self, of_words: np.ndarray) -> np.ndarray:
        """Sums of a value of every word by text."""
        total = sums(of_words)
        return total[self.first[1:]] - total[self.first[:-1]]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split(column: pa.Array | pa.ChunkedArray) -> Words:
    data, offsets = buffers(column)
    inside = ~_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True  # a word never runs from one text into the next
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(table: pa.Table | pa.RecordBatch, text: str = "text", size: int = SLICE) -> Iterator[pa.Table | pa.RecordBatch]:
    """Consecutive rows with about ``size`` bytes of text at a time."""
    if not len(table):
        return
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(table.column(text)), 0))
    ends = np.cumsum(lengths.astype(np.int64))
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield table.slice(i, j - i)
        i = j
