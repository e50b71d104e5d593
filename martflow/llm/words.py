"""Words and 64-bit hashes of texts, for code that runs in tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` words become spaces, A-Z become a-z.
LETTERS_AND_DIGITS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

U = np.uint64
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)  # fixed values: splitmix64
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def space_words(data: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, with A-Z lower-cased."""
    return data.lower().split()


def plain_words(data: bytes) -> list[bytes]:
    """Words of letters, digits and whatever is beyond ASCII, with A-Z lower-cased."""
    return data.translate(LETTERS_AND_DIGITS).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


class WordHashes(dict):
    """Remembers the hash of each word; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(words: list[bytes], hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words are one run."""
    n = len(words)
    if not n:
        return np.empty(0, U)
    w = np.fromiter(map(hashes.__getitem__, words), U, n)
    size = min(size, n)
    total = np.full(n - size + 1, size, U)
    for k in range(size):
        total = mix(total * U(ODD[0]) + w[k : n - size + 1 + k])
    total.sort()
    keep = np.empty(len(total), bool)
    keep[0] = True
    np.not_equal(total[1:], total[:-1], out=keep[1:])
    return total[keep]
