"""Word shingles of a text: exact sets, and 64-bit hashes of them."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(1, 33)]


def words(text: str | None) -> list[bytes]:
    """Runs of anything but blanks and the ASCII controls 9 to 13, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(found: list[bytes], size: int) -> set[bytes]:
    """Distinct runs of ``size`` words; fewer words are one shingle; no word, none."""
    if len(found) <= size:
        return {b" ".join(found)} if found else set()
    return set(map(b" ".join, zip(*(found[i:] for i in range(size)))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hash by word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def hashed(found: list[bytes], size: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    w = np.fromiter(map(memory.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(size, len(w))
    if not size:
        return w
    n = len(w) - size + 1
    h = w[:n] * _ODD[0]
    for k in range(1, size):
        h += w[k:n + k] * _ODD[k]
    return np.unique(mix(h + np.uint64(size)))
