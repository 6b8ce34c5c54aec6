"""Words of a text as arrays of hashes, and hashes of runs of words, for operators on word windows."""

from __future__ import annotations

import numpy as np
import xxhash

#: odd multipliers of the two polynomial hashes of word runs
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
CACHE_WORDS = 300_000


class WordHashes(dict):
    """64-bit hash of each word; forgets all when full, which changes no hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as asked for."""

    def __init__(self, base: np.uint64):
        self.base = int(base)
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            step = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, step, 2**64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, step, 2**64))])
        return self.up[:n], self.down[:n]


_POWERS = tuple(map(Powers, BASES))


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of each run hashes[start:end]; equal runs have equal hashes. `which` picks the family."""
    up, down = _POWERS[which](len(hashes) + 1)
    values = hashes if which == 0 else mixed(hashes, which)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k words in a row."""
    n = len(hashes) - k + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        total = total * BASES[0] + hashes[i : i + n]
    return mixed(total)
