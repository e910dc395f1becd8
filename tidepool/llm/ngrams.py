"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # fixed odd constant of the hash
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int, space: int = 0) -> np.ndarray:
    """Bucket, below 2^bits, of every n-gram of the given sizes. `space` keeps
    n-grams of different fields apart."""
    out = []
    for n in sizes:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, np.uint64(1 + n + 16 * space), np.uint64)
        for k in range(n):
            h = (h ^ points[k:len(points) - n + 1 + k]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
        out.append(((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)
