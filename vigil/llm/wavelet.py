"""A wavelet matrix in numpy: ranks, order statistics and range successors of many queries at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """Bits, 64 to a word, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Of numbers from 0 to 2**bits - 1. Queries are arrays; a range is start (inside) to end (outside).

    A level holds one bit of each number, highest first; below it the numbers
    with a 0 come before those with a 1, in their order. About 1.5 bits a number
    and level.
    """

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.levels = bits, []
        for b in reversed(range(bits)):
            bit = (values >> b & 1).astype(bool)
            zeros = values[~bit]
            self.levels.append((b, Bits(bit), len(zeros)))
            values = np.concatenate([zeros, values[bit]])

    def count(self, value: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank: how often the value occurs in each range."""
        for b, level, zeros in self.levels:
            if value >> b & 1:
                start, end = zeros + level.ones(start), zeros + level.ones(end)
            else:
                start, end = start - level.ones(start), end - level.ones(end)
        return end - start

    def below(self, limit: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many numbers of each range are less than its limit (which must fit the bits)."""
        found = np.zeros(len(start), dtype=np.int64)
        for b, level, zeros in self.levels:
            first, last = level.ones(start), level.ones(end)
            up = (limit >> b & 1).astype(bool)
            found += np.where(up, (end - last) - (start - first), 0)
            start, end = np.where(up, zeros + first, start - first), np.where(up, zeros + last, end - last)
        return found

    def smallest(self, k: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The k-th smallest number of each range, counted from 0; k must be less than the range's length."""
        value = np.zeros(len(start), dtype=np.int64)
        for b, level, zeros in self.levels:
            first, last = level.ones(start), level.ones(end)
            low = (end - last) - (start - first)
            up = k >= low
            k = np.where(up, k - low, k)
            value |= up.astype(np.int64) << b
            start, end = np.where(up, zeros + first, start - first), np.where(up, zeros + last, end - last)
        return value

    def successor(self, limit: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The smallest number of each range that is not below its limit; -1 without one."""
        k = self.below(limit, start, end)
        there = k < end - start
        out = np.full(len(k), -1, dtype=np.int64)
        out[there] = self.smallest(k[there], start[there], end[there])
        return out

    def predecessor(self, limit: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The largest number of each range below its limit; -1 without one."""
        k = self.below(limit, start, end)
        there = k > 0
        out = np.full(len(k), -1, dtype=np.int64)
        out[there] = self.smallest(k[there] - 1, start[there], end[there])
        return out
