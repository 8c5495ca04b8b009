"""Elias-Fano sequences: rising whole numbers in about 2 + log2(universe / length) bits each.

A number is cut into low bits, stored side by side, and a high part, stored as the place of a one in a
bit string: the i-th one stands at high + i. The bytes can lie in memory or in a mapped file.
"""
from __future__ import annotations

import numpy as np


def _low_bits(n: int, universe: int) -> int:
    return max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)


class EliasFano:
    """`words` holds the low bits and the high string as 64-bit words; `ones` counts ones before each word of the latter."""

    def __init__(self, n: int, low: int, low_words: np.ndarray, high_words: np.ndarray):
        self.n, self.low, self.low_words, self.high_words = n, low, low_words, high_words
        self.ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high_words), dtype=np.int64)))

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(length, low bits, low words, high words) of rising numbers below `universe`."""
        values = values.astype(np.uint64)
        n, low = len(values), _low_bits(len(values), universe)
        low_words = np.zeros((n * low + 63) // 64 + 1, np.uint64)
        if low:
            bit = np.arange(n, dtype=np.uint64) * np.uint64(low)
            word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            part = values & np.uint64((1 << low) - 1)
            np.bitwise_or.at(low_words, word, part << shift)
            over = shift + np.uint64(low) > 64
            np.bitwise_or.at(low_words, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(low)) + np.arange(n, dtype=np.uint64)
        high_words = np.zeros((int(place[-1]) >> 6) + 1 if n else 1, np.uint64)
        np.bitwise_or.at(high_words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        return n, low, low_words, high_words

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        return cls(*cls.pack(values, universe))

    @staticmethod
    def _select(words: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Place of the one number `left` (from 0) within each word."""
        bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return (np.cumsum(bits, axis=1, dtype=np.uint8) <= left[:, None]).sum(axis=1)

    def _ones_place(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, side="right") - 1
        return word * 64 + self._select(self.high_words[word], i - self.ones[word])

    def _low_part(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        first = self.low_words[word] >> shift
        second = np.where(shift > 0, self.low_words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        """The numbers at places `i`."""
        out = np.empty(len(i), np.uint64)
        for at in range(0, len(i), chunk):
            part = i[at:at + chunk]
            out[at:at + chunk] = ((self._ones_place(part) - part).astype(np.uint64) << np.uint64(self.low)) | self._low_part(part)
        return out

    def successor(self, values: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        """The first place whose number is not below each value; the length if there is none.

        The high part names a run of places, found by counting zeros; the low bits are searched in it.
        """
        out = np.empty(len(values), np.int64)
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        for at in range(0, len(values), chunk):
            v = values[at:at + chunk].astype(np.uint64)
            high, part = (v >> np.uint64(self.low)).astype(np.int64), v & np.uint64((1 << self.low) - 1)
            a, b = self._run(high - 1, zeros), self._run(high, zeros)
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                less = open_ & (self._low_part(np.minimum(mid, max(self.n - 1, 0))) < part)
                a, b = np.where(less, mid + 1, a), np.where(open_ & ~less, mid, b)
            out[at:at + chunk] = a
        return out

    def _run(self, high: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """How many numbers have a high part of `high` or less: the ones before zero number `high`."""
        inside = (high >= 0) & (high < zeros[-1])
        z = np.where(inside, high, 0)
        word = np.searchsorted(zeros, z, side="right") - 1
        word = np.minimum(word, len(self.high_words) - 1)
        place = word * 64 + self._select(~self.high_words[word], z - zeros[word])
        return np.where(high < 0, 0, np.where(inside, place - z, self.n))
