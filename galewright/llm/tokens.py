"""Byte-level BPE ids of whole texts with the tokenizers library, each distinct pre-token encoded once.

The library splits a text into pre-tokens and encodes each on its own, so a text's ids are its
pre-tokens' ids one after the other. Here numpy finds the pre-token bounds of many texts at once, and
the library encodes only pre-tokens that the worker hasn't met. Code points are classed by asking the
library's own pre-tokenizer about each new one.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
from tokenizers import Tokenizer

from galewright.llm.textarrays import Texts, mixed, ranges, range_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
_UNKNOWN = 255

# The contractions of the pre-tokenizer's pattern.
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@dataclass
class Ids:
    """Ids of texts one after the other; those of text i are ``ids[first[i]:first[i + 1]]``."""

    ids: np.ndarray
    first: np.ndarray


class TextEncoder:
    """Encodes texts with ``path``'s tokenizer, without special tokens, and appends ``end`` to each.

    Known pre-tokens are kept in a hash table with their ids, at most ``known`` of them; beyond that
    the table starts afresh, which costs time but changes no result. A
    tokenizer that isn't plain byte-level BPE (a normalizer, an added prefix space) is refused.
    """

    def __init__(self, path: str, end: int | None = 0, known: int = 2_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end, self.known = end, known
        if self.tokenizer.normalizer is not None or self._split("a b") != [(0, 1), (1, 3)]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.classes = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable()
        self.place = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _split(self, text: str) -> list[tuple[int, int]]:
        return [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _classify(self, points: np.ndarray) -> None:
        for point in points.tolist():
            char = chr(point)
            if len(self._split("a" + char)) == 1:
                found = _LETTER
            elif len(self._split("1" + char)) == 1:
                found = _NUMBER
            elif len(self._split("!" + char)) == 1:
                found = _OTHER
            else:
                found = _SPACE
            self.classes[point] = found

    def bounds(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Start positions of all pre-tokens in the code points of texts one after the other."""
        n = len(codes)
        kind = self.classes[codes]
        if (kind == _UNKNOWN).any():
            self._classify(np.unique(codes[kind == _UNKNOWN]))
            kind = self.classes[codes]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        first = edge[:n].copy()  # of a run of one class
        first[1:] |= kind[1:] != kind[:-1]
        last = np.ones(n, dtype=bool)
        last[:-1] = first[1:]
        space = kind == _SPACE
        blank = codes == 0x20
        # A run of white space gives its last character to what follows in the same text.
        before_more = space & last & ~edge[1:]
        start = (space & first) | before_more
        led = np.zeros(n, dtype=bool)  # runs that begin with the blank before them
        led[1:] = blank[:-1] & ~edge[1:n]
        head = ~space & first
        start |= head & ~led
        quote = np.flatnonzero(head & ~led & (codes == 0x27))
        if len(quote):
            for tail in _CONTRACTIONS:
                stop = quote + 1 + len(tail)
                fits = stop <= n
                for k, char in enumerate(tail):
                    at = np.minimum(quote + 1 + k, n - 1)
                    fits &= (codes[at] == ord(char)) & ~edge[np.minimum(quote + 1 + k, n)]
                here = quote[fits]
                start[here + 1] = False
                after = here + 1 + len(tail)
                # What is left of the letters begins a pre-token of its own.
                inside = after[(after < n)]
                inside = inside[~edge[inside]]
                start[inside[kind[inside] == _LETTER]] = True
                quote = quote[~fits]
        return np.flatnonzero(start)

    def encode(self, texts: Texts) -> Ids:
        text = texts.data.tobytes().decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        lead = np.zeros(len(texts.data) + 1, dtype=np.int64)
        np.cumsum((texts.data & 0xC0) != 0x80, out=lead[1:])
        offsets = lead[texts.offsets]
        start = self.bounds(codes, offsets)
        end = np.append(start[1:], len(codes))
        hashes = range_hashes(mixed(codes.astype(np.uint64) + np.uint64(1)), start, end)
        at = self._places(text, start, end, hashes)
        length = self.length[at]
        token_first = np.searchsorted(start, offsets)
        total = np.concatenate(([0], np.cumsum(length)))[token_first]
        flat = self.pool[ranges(self.place[at], length)]
        if self.end is None:
            return Ids(flat, total)
        n = len(texts)
        ids = np.full(len(flat) + n, self.end, dtype=np.uint32)
        ids[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(total))] = flat
        return Ids(ids, total + np.arange(n + 1))

    def _places(self, text: str, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which entry each pre-token is in the table of known ones; new ones are encoded and added."""
        at = self.table.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            if self.table.used and self.table.used + len(first) > self.known:
                self._forget()
                return self._places(text, start, end, hashes)
            self._learn(text, start, end, hashes, new[first])
            at[new] = self.table.find(hashes[new])
        return at

    def _learn(self, text: str, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, new: np.ndarray) -> None:
        pieces = [text[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        flat = np.fromiter((i for e in encoded for i in e), dtype=np.uint32, count=int(lengths.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), dtype=np.uint32)))
        self.pool[self.used : self.used + len(flat)] = flat
        self.place = np.concatenate((self.place, self.used + np.cumsum(lengths) - lengths))
        self.length = np.concatenate((self.length, lengths))
        self.used += len(flat)
        self.table.add(hashes[new])


class HashTable:
    """Open addressing for whole arrays of 64-bit hashes; an entry's number is its place of arrival."""

    def __init__(self) -> None:
        self.used, self.hashes = 0, np.zeros(0, dtype=np.uint64)
        self._size(1 << 16)

    def _size(self, size: int) -> None:
        self.mask = size - 1
        self.slots = np.full(size, -1, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entries of these hashes, -1 for an unknown one."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if not self.used:
            return out
        slot = (hashes & np.uint64(self.mask)).astype(np.int64)
        entry = self.slots[slot]
        hit = (entry >= 0) & (self.hashes[entry] == hashes)
        out[hit] = entry[hit]
        left = np.flatnonzero((entry >= 0) & ~hit)
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            entry = self.slots[slot]
            hit = (entry >= 0) & (self.hashes[entry] == hashes[left])
            out[left[hit]] = entry[hit]
            on = (entry >= 0) & ~hit
            left, slot = left[on], slot[on]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Add hashes that are distinct and unknown."""
        self.hashes = np.concatenate((self.hashes, hashes))
        new = np.arange(self.used, len(self.hashes))
        self.used = len(self.hashes)
        if 2 * self.used > self.mask:
            self._size(1 << int(4 * self.used).bit_length())
            new = np.arange(self.used)
        slot = (self.hashes[new] & np.uint64(self.mask)).astype(np.int64)
        while len(new):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = new[free]
            on = self.slots[slot] != new
            new, slot = new[on], (slot[on] + 1) & self.mask


_ENCODERS: dict[tuple[str, int | None], TextEncoder] = {}


def encoder(path: str, end: int | None = 0) -> TextEncoder:
    """The worker's encoder for this tokenizer file; kept between tasks."""
    key = (path, end)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, end)
    return _ENCODERS[key]
