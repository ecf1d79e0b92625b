"""Hashes of ranges by sums of powers modulo 2**64, in numpy."""

from __future__ import annotations

import numpy as np

BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, for hashes of ranges."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(0, np.uint64), np.ones(0, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if n > len(self.up):
            size = max(n, 1 << 16)
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.append(one, np.full(size - 1, self.base, np.uint64)))
            inverse = pow(self.base, -1, 1 << 64)
            self.down = np.cumprod(np.append(one, np.full(size - 1, inverse, np.uint64)))
        out = np.zeros(n + 1, np.uint64)
        np.multiply(values, self.up[:n], out=out[1:])
        return np.cumsum(out, out=out)

    def ranges(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((sums[stop] - sums[start]) * self.down[start])
