"""Hashes of stretches of bytes, many at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from sedimenta.llm.common import kept

# Arrays of a number per byte then stay below what workers map anew for every array (2 MB).
HASHED_BYTES = 200_000


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64: with prefix sums of the bytes'
    numbers times powers, any stretch has its hash in one subtraction and one product."""

    def __init__(self):
        rng = np.random.default_rng(50)
        self.byte = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        one = np.ones(1, dtype=np.uint64)
        self.up = np.cumprod(np.concatenate((one, np.full(n, self.base))), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate((one, np.full(n, self.inverse))), dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.grow(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def stretch(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def powers() -> Powers:
    """One table per worker process."""
    return kept("powers", Powers)


def parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about HASHED_BYTES together, to bound what is hashed at once."""
    lo, total = 0, 0
    for at, size in enumerate(sizes):
        total += size
        if total >= HASHED_BYTES:
            yield lo, at + 1
            lo, total = at + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)
