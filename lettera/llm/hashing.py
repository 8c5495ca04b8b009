"""Vectorised hashes of the words of a text; used inside tasks."""
from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + np.uint64((0x632BE59BD9B4E019 * (salt + 1)) % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str, fold_ascii: bool = False) -> np.ndarray:
    """One 64-bit hash for each word (bytes other than ASCII white space), in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    if fold_ascii:
        raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    edge = np.diff(np.concatenate(([1], _SPACE[raw], [1])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _tables(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)])))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for every `n` neighbouring words; all words together if there are fewer."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    found = np.full(len(hashes) - n + 1, np.uint64(n))
    for i in range(n):
        found = mixed(found, i) + hashes[i:len(hashes) - n + 1 + i]
    return mixed(found, n)
