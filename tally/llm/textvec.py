"""Arrow text columns as numpy arrays: words, hashes and n-grams without Python strings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts worked on together; one longer text is taken whole
_P = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def is_blank(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[\\x20\\x09-\\x0D]``."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _P + np.uint64(seed))


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = random_words(7, 256)
    if lower:
        values[65:91] = values[97:123]
    return values


_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + CHUNK_BYTES // 2)
        base, inverse = np.full(size, _P), np.full(size, np.uint64(pow(int(_P), -1, 1 << 64)))
        base[0] = inverse[0] = 1
        _powers, _inverses = np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    return _powers, _inverses


class Texts:
    """A run of texts as one byte array: each text between single blanks.

    ``first`` is the row of the first text in its batch, ``data`` the bytes,
    ``start``/``end`` each text's place in them.
    """

    def __init__(self, first: int, raw: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        n = len(lengths)
        self.first, self.n = first, n
        self.start = offsets[:-1] - offsets[0] + np.arange(1, n + 1)
        self.end = self.start + lengths
        self.data = np.full(int(lengths.sum()) + n + 1, 32, dtype=np.uint8)
        keep = np.ones(len(self.data), dtype=bool)
        keep[0] = False
        keep[self.end] = False
        self.data[keep] = raw[offsets[0]:offsets[-1]]

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, places, side="right") - 1

    def words(self, separator: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each maximal run of bytes that aren't separators (blanks unless given)."""
        inside = ~(is_blank(self.data) if separator is None else separator)
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        return edge[::2], edge[1::2]

    def prefix_hash(self, lower: bool = True) -> np.ndarray:
        """Running polynomial hash of the bytes; A-Z count as a-z with ``lower``."""
        powers, _ = _power_tables(len(self.data) + 1)
        out = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_byte_values(lower)[self.data] * powers[:len(self.data)], out=out[1:])
        return out

    @staticmethod
    def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each span of bytes, the same wherever the span stands."""
        _, inverses = _power_tables(len(prefix))
        return mix((prefix[end] - prefix[start]) * inverses[start])


def texts_of(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow string column in runs of about ``chunk_bytes``; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1
        to = min(n, max(to, at + 1), at + 65536)
        yield Texts(at, raw, offsets[at:to + 1])
        at = to
