"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, hashes, sums per document.

The functions work on slices of a batch of about ``SLICE_BYTES`` of text, so that their temporary
arrays stay small however many rows a batch holds; a single longer text is a slice of its own. NULL
texts are empty texts. Nothing here knows Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, size=256, dtype=np.uint64)


@dataclass
class Texts:
    """Texts ``row .. row + n`` of a batch: text i is ``data[offsets[i]:offsets[i + 1]]`` (UTF-8)."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Split a string column into slices of about ``limit`` bytes, at least one row each."""
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    return _LOWER[data]


@dataclass
class Words:
    """Words ``[start, end)`` in byte positions; those of text i are ``first[i]:first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def runs(inside: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of True that don't cross from one text into the next."""
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    if n:
        starts[1:] &= ~inside[:-1] | edge[1:n]
        ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def words(texts: Texts) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return runs(~_SEPARATOR[texts.data], texts.offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 1))
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _POWERS, _INVERSES = tables
    return _POWERS[:n], _INVERSES[:n]


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``values[start:end]`` (uint64 values), whatever the position.

    A polynomial with an odd base modulo 2^64: the difference of two prefix sums, shifted back to
    the origin by the inverse of the base.
    """
    power, inverse = _powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[:-1], out=prefix[1:])
    return mixed((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    return range_hashes(BYTE_VALUES[data], found.start, found.end)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of an ordered pair of hashes."""
    return mixed(left * np.uint64(0x9FB21C651E98DF25) + (right ^ np.uint64(0x2545F4914F6CDD1D)))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for every i; 0 for none. Integers stay exact."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    total = np.zeros(len(values) + 1, dtype=kind)
    np.cumsum(values, out=total[1:], dtype=kind)
    return total[first[1:]] - total[first[:-1]]


def add_up(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Like ``sums``, for float values of one or two axes, each text added on its own (no rounding
    carried over from its neighbours, so a text's result doesn't depend on its batch)."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), dtype=np.float64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(values, first[some], axis=0, dtype=np.float64)
    return out


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of all ranges one after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - before, length)
