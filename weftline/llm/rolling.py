"""Prefix polynomial hashes over bytes (modulo 2**64, with random byte values)."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
#: The multiplicative inverse of BASE modulo 2**64.
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: A random odd value for each byte.
VALUE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1)."""
    held = _powers.get(int(base))
    if held is None or len(held) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        held = _powers[int(base)] = np.multiply.accumulate(out)
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Prefix:
    """Hashes of any substring of ``data`` in constant time."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUE[data] * powers(BASE, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * powers(INVERSE, len(self.sums))[start]
