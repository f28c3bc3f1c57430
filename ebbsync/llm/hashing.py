"""Hashes of words and word runs as arrays, for operators that run in Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

from ebbsync.llm.text import SHINGLE_WORDS

_CACHED_WORDS = 300_000


class WordHashes(dict):
    """The 64-bit hash of each word, remembered up to a bounded number of words.

    Texts come as UTF-8: ``bytes.split`` parts at exactly the white space of ``text.WORD``.
    """

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95)
    return values ^ (values >> np.uint64(32))


def run_hashes(words: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash of every run of ``width`` words; of fewer words, one hash of them all."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = mix(total + words[i : len(words) - width + 1 + i])
    return total
