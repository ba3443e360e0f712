"""Character shingles as 64-bit hashes, made by numpy over the texts of an Arrow batch.

A window of k code points is mixed into 64 bits, all windows of a text at once; no shingle becomes a string. Two different
shingles have one hash once in 2^64 pairs.
"""

from __future__ import annotations

import numpy as np

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _MIX
    x ^= x >> np.uint64(27)
    return x


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct k-grams of a text; none if it is shorter than k or null."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(points) - k + 1
    if n < 1:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += points[j : j + n]
        h *= _ODD
        h = _mixed(h)
    return np.unique(h.view(np.int64))


def minima(sets: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The least value of a set under each of several hash functions, as unsigned numbers."""
    x = sets.view(np.uint64)
    return np.array([_mixed((x + s) * _ODD).min() for s in seeds.view(np.uint64)], np.uint64)


def parity(sets: np.ndarray, bits: int) -> np.ndarray:
    """Of each of some bits whether an odd number of the set's elements fall on it: two sets differ in as many elements at least as these differ in bits."""
    fell = np.bincount((sets.view(np.uint64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(fell.astype(np.uint8)).view("<i8")
