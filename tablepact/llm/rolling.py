"""Hashes of any span of a byte array, from one pass over it."""

from __future__ import annotations

import numpy as np


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values; distinct ones stay distinct."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class RollingHash:
    """Polynomial hashes modulo 2**64 of spans, by prefix sums.

    The base is odd, so it has an inverse, which moves a span to where it would be at
    the start. Bytes stand for scattered numbers.
    """

    BASE = 0x5851F42D4C957F2D
    BYTES = mix(np.arange(1, 257, dtype=np.uint64))

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)
        self.prefix = np.zeros(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                values = np.full(n, base, np.uint64)
                values[0] = 1
                setattr(self, name, np.cumprod(values))
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum(self.BYTES[data] * self.up[: n - 1], out=self.prefix[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.down[start]
