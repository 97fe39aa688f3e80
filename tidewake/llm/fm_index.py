"""A compressed FM-index over short word sequences.

The Burrows-Wheeler transform is sorted by the first symbols of each suffix
only, as far as patterns reach; intervals of patterns up to that length are the
same as under a full sort. It is kept in a wavelet tree (as a wavelet matrix):
one bit vector per bit of the alphabet, packed, with a count per 64 bits.
Searches run for many patterns at a time.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.uint32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


class FMIndex:
    """Index of ``symbols`` (0 ends a sequence; the others are 1 to ``alphabet - 1``) for patterns up to ``reach`` symbols."""

    def __init__(self, symbols: np.ndarray, alphabet: int, reach: int):
        n = len(symbols)
        # Ranks by 1, 2, 4, ... symbols. Ends differ from each other, so that no suffix runs over one.
        rank = symbols.astype(np.int64)
        ends = np.flatnonzero(symbols == 0)
        rank += len(ends)
        rank[ends] = np.arange(len(ends))
        width = 1
        while True:
            follow = np.zeros(n, np.int64)
            follow[: n - width] = rank[width:] + 1
            key = rank * (n + alphabet + 2) + follow
            # Equal keys may come in any order: patterns don't reach beyond them.
            order = np.argsort(key)
            width *= 2
            ranked = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            if width >= reach:
                break
        self.suffixes = order
        last = symbols[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])[:alphabet]
        # Wavelet matrix from the highest bit down.
        self.levels, self.zeros = [], []
        self.bits = max(1, int(alphabet - 1).bit_length())
        for b in range(self.bits - 1, -1, -1):
            bit = ((last >> b) & 1).astype(bool)
            self.levels.append(BitVector(bit))
            self.zeros.append(int(n - bit.sum()))
            last = np.concatenate([last[~bit], last[bit]])
        self.bottom = np.zeros(alphabet, np.int64)
        heads = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        self.bottom[last[heads]] = heads
        self.size = n

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of ``symbol`` followed by what [low, high) stands for."""
        at = np.concatenate([low, high])
        twice = np.concatenate([symbol, symbol])
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(at)
            right = (twice >> (self.bits - 1 - level)) & 1 == 1
            at = np.where(right, zeros + ones, at - ones)
        at += self.first[twice] - self.bottom[twice]
        return at[: len(symbol)], at[len(symbol):]

    def statistics(self, symbols: np.ndarray, starts: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the windows of ``reach`` symbols at ``starts``, right to left: (length, low, high).

        A window whose interval gets empty keeps the length reached and its last interval.
        """
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.size)
        length, going = np.zeros(len(starts), np.int64), np.arange(len(starts))
        for k in range(reach - 1, -1, -1):
            l, h = self.extend(symbols[starts[going] + k], low[going], high[going])
            found = l < h
            going, l, h = going[found], l[found], h[found]
            low[going], high[going] = l, h
            length[going] += 1
            if not len(going):
                break
        return length, low, high
