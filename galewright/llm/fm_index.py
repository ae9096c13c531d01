"""A compressed full-text index of words: BWT in a wavelet tree, searched backwards for many texts at once.

Suffixes are ordered by their first ``cap`` symbols or a few more, which makes every interval of a
pattern of up to ``cap`` symbols exact. Nothing here knows Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class RankedBits:
    """Bits in words of 64, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        whole = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        whole[: len(bits)] = bits
        self.words = np.packbits(whole, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.zeros = len(bits) - int(np.count_nonzero(bits))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Symbols by levels, the highest bit first; in each level zeros go before ones."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.levels: list[tuple[int, RankedBits]] = []
        for place in range(max(1, (kinds - 1).bit_length()) - 1, -1, -1):
            bits = (symbols >> place) & 1
            self.levels.append((place, RankedBits(bits)))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.first = self._walk(np.arange(kinds), np.zeros(kinds, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for place, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> place) & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._walk(symbol, at) - self.first[symbol]


@dataclass(frozen=True)
class Matches:
    """For every position of the streamed texts: the longest match that starts there, at most ``cap``, and
    where that is ``cap``, the block of suffixes that begin with it (else -1)."""

    length: np.ndarray
    block: np.ndarray


class FMIndex:
    """Texts ``words[first[i]:first[i + 1]]`` of 64-bit word hashes, indexed for matches of up to ``cap`` words."""

    def __init__(self, words: np.ndarray, first: np.ndarray, cap: int):
        self.cap = cap
        self.alphabet, ranks = np.unique(words, return_inverse=True)
        size = np.diff(first)
        of = np.repeat(np.arange(len(size)), size)
        symbols = np.zeros(len(words) + len(size) + 1, dtype=np.int64)  # 0 ends a text
        symbols[np.arange(len(words)) + of] = ranks + 1
        self.n = len(symbols)
        self._doubled = {1: symbols}
        width = 1
        while width < cap:
            self._doubled[2 * width] = self._pairs(width, width)
            width *= 2
        order = np.argsort(self._doubled[width], kind="stable")
        kinds = len(self.alphabet) + 1
        before = symbols[order - 1]  # the symbol before a suffix; before the first one, the last end
        self.tree = WaveletTree(before, kinds)
        self.counts = np.zeros(kinds + 1, dtype=np.int64)
        np.cumsum(np.bincount(symbols, minlength=kinds), out=self.counts[1:])
        self._order = order
        self._starts: dict[int, np.ndarray] = {}
        text_of = np.zeros(self.n, dtype=np.int64)
        text_of[:-1] = np.repeat(np.arange(len(size)), size + 1)
        self.text_of_row = text_of[order]
        starts = self.starts(cap)
        for length in range(1, cap):
            self.starts(length)
        self.blocks = len(starts)
        del self._order, self._doubled

    def _pairs(self, width: int, shift: int) -> np.ndarray:
        """Ranks of the first ``width + shift`` symbols, from ranks of ``width`` (shift <= width)."""
        held = self._doubled[width]
        later = np.zeros(self.n, dtype=np.int64)
        later[:-shift] = held[shift:]
        return np.unique(held * (int(held.max()) + 1) + later, return_inverse=True)[1]

    def starts(self, length: int) -> np.ndarray:
        """First rows of the runs of suffixes that agree in ``length`` symbols."""
        if length not in self._starts:
            width = 1 << (length.bit_length() - 1)
            held = self._doubled[width][self._order]
            new = np.ones(self.n, dtype=bool)
            new[1:] = held[1:] != held[:-1]
            if length > width:
                at = self._order + (length - width)
                later = np.where(at < self.n, self._doubled[width][np.minimum(at, self.n - 1)], 0)
                new[1:] |= later[1:] != later[:-1]
            self._starts[length] = np.flatnonzero(new)
        return self._starts[length]

    def least_by_block(self, values: np.ndarray) -> np.ndarray:
        """The smallest of the texts' values in every block of suffixes that agree in ``cap`` symbols."""
        return np.minimum.reduceat(values[self.text_of_row], self.starts(self.cap))

    def _widened(self, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the first ``length`` symbols of what the rows in ``low`` match."""
        new_low, new_high = np.zeros(len(low), dtype=np.int64), np.full(len(low), self.n, dtype=np.int64)
        for wanted in np.unique(length[length > 0]):
            of = np.flatnonzero(length == wanted)
            starts = self.starts(int(wanted))
            at = np.searchsorted(starts, low[of], side="right")
            new_low[of] = starts[at - 1]
            new_high[of] = np.append(starts, self.n)[at]
        return new_low, new_high

    def matching_statistics(self, words: np.ndarray, first: np.ndarray) -> Matches:
        """Matches of texts ``words[first[i]:first[i + 1]]`` with the indexed texts.

        All texts advance together from their ends. A match is extended to the left by one backward step;
        where it can't be, or has ``cap`` words, its last word is dropped until it can.
        """
        at = np.minimum(np.searchsorted(self.alphabet, words), max(len(self.alphabet) - 1, 0))
        known = self.alphabet[at] == words if len(self.alphabet) else np.zeros(len(words), dtype=bool)
        symbols = np.where(known, at + 1, 0)
        length, block = np.zeros(len(words), dtype=np.int64), np.full(len(words), -1, dtype=np.int64)
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        ends, falling = first[1:][order], -size[order]
        n = len(order)
        low, high, held = np.zeros(n, dtype=np.int64), np.full(n, self.n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        cap_starts = self.starts(self.cap)
        for step in range(int(size.max(initial=0))):
            active = int(np.searchsorted(falling, -step, side="left"))
            place = ends[:active] - 1 - step
            symbol = symbols[place]
            lost = np.flatnonzero(symbol == 0)
            low[lost], high[lost], held[lost] = 0, self.n, 0
            full = np.flatnonzero(held[:active] == self.cap)
            if len(full):
                held[full] -= 1
                low[full], high[full] = self._widened(low[full], held[full])
            trying = np.flatnonzero(symbol > 0)
            while len(trying):
                wanted = symbol[trying]
                both = self.tree.rank(np.concatenate([wanted, wanted]), np.concatenate([low[trying], high[trying]]))
                begin = self.counts[wanted]
                new_low, new_high = begin + both[: len(trying)], begin + both[len(trying) :]
                found = new_low < new_high
                hit = trying[found]
                low[hit], high[hit] = new_low[found], new_high[found]
                held[hit] += 1
                trying = trying[~found]
                held[trying] -= 1
                low[trying], high[trying] = self._widened(low[trying], held[trying])
            length[place] = held[:active]
            whole = np.flatnonzero(held[:active] == self.cap)
            block[place[whole]] = np.searchsorted(cap_starts, low[whole])
        return Matches(length, block)
