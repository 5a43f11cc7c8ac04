"""Prefix polynomial hashes of bytes: the hash of any piece in constant time, in numpy.

With a value for each byte and an odd base b, sums[i] adds up value * b^k over the first i
bytes, modulo 2^64. As b has an inverse, (sums[j] - sums[i]) * b^-i depends on the bytes of
[i, j) alone. A last mixing step spreads the weak low bits.

Some long texts collide modulo a power of two whatever the base (the Thue-Morse words). pieces()
therefore also takes a sum modulo the prime 2^31 - 1, of other values and another base.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []
_PRIME = (1 << 31) - 1
_PRIME_BASE = 48271
_PRIME_INVERSE = pow(_PRIME_BASE, -1, _PRIME)
_PRIME_VALUES = np.random.default_rng(20240301).integers(1, _PRIME, 512, dtype=np.uint64)
_PRIME_POWERS: list[np.ndarray] = []


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least so many."""
    if not _POWERS or len(_POWERS[0]) < size:
        made = max(size, 1 << 16)
        made = 1 << (made - 1).bit_length()
        _POWERS[:] = [
            np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(made - 1, b, np.uint64))])
            for b in (_BASE, _INVERSE)
        ]
    return _POWERS


def _folded(x: np.ndarray) -> np.ndarray:
    """Equal to x modulo the prime, and below 2^33 for x below 2^63."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _prime_powers(size: int) -> list[np.ndarray]:
    """The same modulo the prime."""
    if not _PRIME_POWERS or len(_PRIME_POWERS[0]) < size:
        found = []
        for base in (_PRIME_BASE, _PRIME_INVERSE):
            powers = np.ones(1, np.uint64)
            while len(powers) < max(size, 1 << 16):
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), _PRIME)) % np.uint64(_PRIME)])
            found.append(powers)
        _PRIME_POWERS[:] = found
    return _PRIME_POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


class PrefixHash:
    """Hashes of pieces of some bytes, or of numbers below 512."""

    def __init__(self, data: np.ndarray):
        self.data, self.prime_sums = data, None
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * powers[: len(data)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal pieces; good for comparing pieces of one length."""
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def windows(self, size: int) -> np.ndarray:
        """raw() of every piece of so many bytes, by its start."""
        count = max(0, len(self.sums) - size)
        return (self.sums[size:] - self.sums[:count]) * self.inverse[:count]

    def _prime(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        powers, inverse = _prime_powers(len(self.data) + 1)
        if self.prime_sums is None:
            self.prime_sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_folded(_PRIME_VALUES[self.data] * powers[: len(self.data)]), out=self.prime_sums[1:])
        return (self.prime_sums[end] - self.prime_sums[start]) % np.uint64(_PRIME) * inverse[start] % np.uint64(_PRIME)

    def pieces(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A scrambled hash of both sums that also depends on the length."""
        size = (end - start).astype(np.uint64)
        return mixed(self.raw(start, end) + size * np.uint64(_BASE) + self._prime(start, end) * np.uint64(0xC2B2AE3D27D4EB4F))
