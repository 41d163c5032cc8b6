"""Minimal perfect hashing of distinct 64-bit keys, built bucket by bucket in tasks.

Keys fall into buckets by hash.  A bucket's function has levels: at each, the keys
left are hashed into twice as many bits; a key alone in its place is placed there,
the others go on to the next level.  A key's index is the number of places taken
before its own, so n keys have the indexes 0 to n - 1; a bucket's keys are neighbours.
"""

from __future__ import annotations

import numpy as np

#: Bits a key left at a level.
SPARE = 2
_MULTIPLIERS = tuple(map(np.uint64, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well mixed unsigned 64-bit hash of every key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _STEP * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
        x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
        return x ^ (x >> np.uint64(31))


def _place(keys: np.ndarray, seed: int, size) -> np.ndarray:
    """A place below ``size`` (under 2**32, a number or one a key) for every key."""
    return ((mix(keys, seed) >> np.uint64(32)) * np.asarray(size, dtype=np.uint64) >> np.uint64(32)).astype(np.int64)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return _place(keys, 0, n_buckets)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the places taken as words of 64 bits, the keys in the order of their index) of distinct keys."""
    left, sizes, words, placed = keys, [], [], []
    while len(left):
        size = -(-SPARE * len(left) // 64) * 64
        at = _place(left, len(sizes) + 1, size)
        taken = np.bincount(at, minlength=size) == 1
        alone = taken[at]
        placed.append(left[alone][np.argsort(at[alone])])
        words.append(np.packbits(taken, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone]
    empty = np.zeros(0, dtype="<u8")
    return sizes, np.concatenate([empty, *words]), np.concatenate([np.zeros(0, dtype=np.int64), *placed])


class PerfectHash:
    """The functions of a run of buckets, numbered from ``first``, read together; keys are verified."""

    def __init__(self, n_buckets: int, first: int, sizes: list[list[int]], words: list[np.ndarray], keys: list[np.ndarray]):
        self.n_buckets, self.first = n_buckets, first
        depth = max([1, *map(len, sizes)])
        self.sizes = np.array([list(s) + [0] * (depth - len(s)) for s in sizes], dtype=np.int64).reshape(-1, depth)
        starts = np.cumsum(self.sizes.ravel())
        self.starts = (starts - self.sizes.ravel()).reshape(-1, depth)
        self.words = np.concatenate([np.zeros(0, dtype="<u8"), *words])
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.keys = np.concatenate([np.zeros(0, dtype=np.int64), *keys])
        self.edges = np.cumsum([0, *map(len, keys)])

    def __len__(self) -> int:
        return len(self.keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of every key, -1 for keys that are none of ours."""
        out = np.full(len(keys), -1, dtype=np.int64)
        bucket = bucket_of(keys, self.n_buckets) - self.first
        todo = np.flatnonzero((bucket >= 0) & (bucket < len(self.sizes)))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[bucket[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            bit = self.starts[bucket[todo], level] + _place(keys[todo], level + 1, size)
            word, offset = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            here = (word >> offset) & np.uint64(1) == 1
            rank = self.before[bit >> 6] + np.bitwise_count(word & ((np.uint64(1) << offset) - np.uint64(1)))
            out[todo[here]] = rank[here]
            todo = todo[~here]
        if len(self.keys):
            out[(out >= 0) & (self.keys[out] != keys)] = -1
        return out
