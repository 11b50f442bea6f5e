"""Words of UTF-8 texts as 64-bit hashes, with a bounded cache, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

MASK = 2**64 - 1


class WordHashes(dict):
    """word -> xxh3_64; two generations of `size` words at most."""

    def __init__(self, size: int = 100_000):
        super().__init__()
        self.size, self.old = size, {}

    def hash(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def __missing__(self, word: bytes) -> int:
        found = self.old.get(word)
        if found is None:
            found = self.hash(word)
        if len(word) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(text: bytes, cache: WordHashes) -> np.ndarray:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` of a text, A-Z in lower case."""
    words = text.lower().split()  # of bytes: both know ASCII only
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def multiplier(place: int) -> np.uint64:
    """An odd number for each place of a run. They must not be in proportion: with 1, 3, 5, 7, 9 times one number, a a a b b
    and b b b b a are one run, as 9 + 16 = 25."""
    with np.errstate(over="ignore"):
        return mix(np.uint64(0x9E3779B97F4A7C15) * np.uint64(place + 1)) | np.uint64(1)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Distinct hashes of all runs of `width` words, sorted; of all words as one run if there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        out += words[j : j + n] * multiplier(j)
    return np.unique(mix(out))
