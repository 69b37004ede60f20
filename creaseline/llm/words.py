"""Words and word shingles of whole texts, as 64-bit hashes in numpy arrays.

Texts are lower-cased (A-Z) and split at ASCII blanks; a shingle is five words in a row,
and a text with fewer words is one shingle as a whole. Everything runs on UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
WORDS_KEPT = 200_000
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    """Hashes of the words seen so far; starts anew when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    x = x + MIX[0]
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | bytes | None, seen: WordHashes) -> np.ndarray:
    if text is None:
        return np.empty(0, np.uint64)
    raw = text if isinstance(text, bytes) else text.encode("utf8", "surrogatepass")
    words = raw.lower().split()
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def shingles_in_order(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of the shingle at each position; one for a shorter text, none without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, size)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = total * MIX[0] + words[k : n - width + 1 + k]
    return mixed_bits(total)


def shingle_set(text: str | bytes | None, seen: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingles."""
    return np.unique(shingles_in_order(word_hashes(text, seen), size))


def set_signature(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set, whatever the order; 0 for the empty set."""
    if not len(shingles):
        return 0
    mixed = mixed_bits(shingles)
    parts = np.array([mixed.sum(), np.bitwise_xor.reduce(mixed), len(shingles)], np.uint64)
    return int(mixed_bits(mixed_bits(mixed_bits(parts[:1]) + parts[1:2]) + parts[2:]).view(np.int64)[0])
