"""Hashes of many substrings of one byte array at once."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 5
#: A random 64-bit number for every byte, the same everywhere.
BYTE_CODES = np.random.default_rng(20240229).integers(0, 2**64 - 1, 256, np.uint64, endpoint=True)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Substrings:
    """Hashes of substrings [start, end) of ``data``; equal bytes have equal hashes in any array."""

    def __init__(self, data: np.ndarray):
        up = powers(BASE, len(data) + 1)
        self.down = powers(pow(BASE, -1, 2**64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def hashes(self, start: np.ndarray | slice, end: np.ndarray | slice, length: np.ndarray | int) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mixed(raw + np.asarray(length).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
