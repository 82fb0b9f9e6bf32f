r"""Sets of word shingles as 64-bit hashes: A-Z lower-cased, words ``[^\x20\x09-\x0D]+``.

``bytes.lower`` and ``bytes.split`` know exactly these letters and these six white-space bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (all bits depend on all bits)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``size`` words make one shingle, none make none."""
    hashes = word_hashes(words_of(text))
    n = len(hashes)
    if not n:
        return hashes
    width = min(n, size)
    with np.errstate(over="ignore"):
        total = np.zeros(n - width + 1, dtype=np.uint64)
        for j in range(width):
            total = total * _STEP + hashes[j : n - width + 1 + j]
        total += np.uint64(width) * _STEP
    return np.unique(mix(total))
