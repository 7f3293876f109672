"""Word hashes and mixers for numpy code that runs inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    if seed:
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
