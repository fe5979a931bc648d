"""Hashes of words and of runs of words, on flat arrays."""

from __future__ import annotations

import numpy as np
import xxhash

CACHED_WORDS = 300_000
_BASE = 0x9E3779B97F4A7C15  # 5 when divided by 8: its powers differ in their high bits


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """64-bit hashes by word, worked out when first asked for, within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` hashes, over one flat array (modulo 2^64)."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.r_[np.uint64(0), np.cumsum(hashes * powers, dtype=np.uint64)]
    return mix64((sums[length:] - sums[:-length]) * inverse[: n - length + 1])
