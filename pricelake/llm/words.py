"""Words, word hashes and shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

_MEMO = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word (bytes); forgets all when it holds many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    r"""The words ``[^\x20\x09-\x0D]+`` in UTF-8 (bytes.split() cuts at exactly these six characters)."""
    return text.encode("utf-8").split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n words in a row; empty if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out *= _ODD
        out += words[j : len(words) - n + 1 + j]
    return mix(out)
