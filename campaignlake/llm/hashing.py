"""Hashes of the words of many texts at once, as numpy operations on their joined bytes."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SEED = 20240229


def _odd(rng, n: int) -> np.ndarray:
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits of the input reach all bits of the result."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class WordHasher:
    """Words of a batch of texts: where they stand in the joined bytes, whose they are, and their hashes.

    A word's hash is a polynomial over random values of its bytes, read off running sums, so no word
    becomes a Python object. Words are the maximal runs of bytes other than the space and 9 to 13.
    """

    def __init__(self, lower: bool):
        rng = np.random.default_rng(_SEED)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64)
        if lower:
            self.values[65:91] = self.values[97:123]
        self.within = np.ones(256, dtype=bool)
        self.within[[9, 10, 11, 12, 13, 32]] = False
        self.step = int(_odd(rng, 1)[0])
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 21)
            inverse = pow(self.step, -1, 1 << 64)
            for name, base in (("power", self.step), ("inverse", inverse)):
                row = np.full(n, base, dtype=np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))

    def spans(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of runs of bytes."""
        n = len(joined)
        self._grow(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[joined] * self.power[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def split(self, texts: list[bytes]):
        """(joined bytes, starts, ends, hashes, first word of each text and the end)."""
        joined = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
        n = len(joined)
        self._grow(n + 1)
        inside = self.within[joined]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.values[joined] * self.power[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        text_at = np.cumsum([1, *[len(x) + 1 for x in texts]])
        return joined, starts, ends, hashes, np.searchsorted(starts, text_at)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive values; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factors = _odd(np.random.default_rng(_SEED + size), size)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * factors[k]
    return mix(total)
