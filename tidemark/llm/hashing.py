"""64-bit hashes of words and shingles with numpy, used inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """Word (bytes) to 64-bit hash; emptied when it grows past its bound, so memory stays bounded."""

    BOUND = 60_000  # some 200 bytes each

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[bytes]:
    """bytes.lower() and bytes.split() touch A-Z and [\\x20\\x09-\\x0D] alone, as the contracts ask."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_shingles(text: str | None, width: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of `width` words; a shorter text is one shingle."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    span = min(width, len(found))
    rows = len(h) - span + 1
    acc = np.full(rows, span, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(span):
            acc = mix(acc + h[j : j + rows]) * STEP
        return np.unique(mix(acc))


def fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit value for a set of shingles; order plays no part."""
    with np.errstate(over="ignore"):
        both = mix(np.array([mix(shingles ^ STEP).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64))
    return int(both.view(np.int64)[0])
