"""Words of many texts as numbers: one pass of Python over the words, arrays from there on."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import xxhash

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def numbered(words: Iterable[bytes], first: bytes | None = None) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word, by first appearance, and the distinct words; ``first`` gets number 0."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    if first is not None:
        numbers[first]  # noqa: B018 - takes number 0
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64)
    return ids, list(numbers)


def hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, in their order."""
    with np.errstate(over="ignore"):
        x = (left ^ (left >> np.uint64(29))) * _MIX[0] + right
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))
