"""Word and window hashes as numpy arrays, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every window of ``k`` words, by start."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rolled = hashes[:n].copy()
    for j in range(1, k):
        rolled *= _BASE
        rolled += hashes[j : n + j]
    return mix(rolled + np.uint64(seed))
