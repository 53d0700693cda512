"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS_KEPT = 100_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORDS_KEPT:
            self[word] = value
        return value


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased A-Z; words are what stands between bytes 0x20 and 0x09 to 0x0D."""
    return text.lower().split()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def shingle_sequence(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in order; of all of them if they are fewer."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = _mixed(found * _MIX[0] + hashes[k : k + count])
    return found


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles, ascending."""
    words = words_of(text)
    return np.unique(shingle_sequence(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), size))
