"""Word shingles and minima of permuted hashes, on the flat arrays of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
SLICE = 300_000
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers that depend on nothing but the arguments."""
    draw = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, size=count, dtype=np.uint64)
    return draw * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def slices(array: pa.ListArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, words, words per row) in runs with a bounded number of words."""
    values, ends = array.values.to_numpy(zero_copy_only=False), array.offsets.to_numpy()
    low = 0
    while low < len(array):
        high = int(np.searchsorted(ends, ends[low] + SLICE, side="left"))
        high = min(max(high, low + 1), len(array))
        yield low, high, values[ends[low] : ends[high]].view(np.uint64), np.diff(ends[low : high + 1])
        low = high


def shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of the shingles of all rows, in order.

    A row with fewer words than ``WIDTH`` has one shingle of all its words; one without
    words has none.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = ends[owner] - np.arange(len(words))
    value = np.zeros(len(words), dtype=np.uint64)
    for k, c in enumerate(constants(WIDTH, 5)):
        part = np.zeros(len(words), dtype=np.uint64)
        part[: max(0, len(words) - k)] = words[k:] * c
        value += np.where(left > k, part, np.uint64(0))
    first = np.arange(len(words)) - (ends - counts)[owner]
    own = (left >= WIDTH) | (first == 0)
    return mixed(value[own]), owner[own], first[own]
