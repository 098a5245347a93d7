"""Words of a text as bytes, and hashes of them, for operators on word shingles.

Words are lower-cased runs of ASCII letters, digits and underscores and of all
characters beyond ASCII; everything else parts words.
"""

from __future__ import annotations

import numpy as np
import xxhash

_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789_")
_TABLE = bytes(c if c in _WORD or c >= 0x80 else 0x20 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[0]
    return x ^ (x >> np.uint64(31))


def word_hashes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, own), dtype=np.uint64, count=len(own))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``n`` words; a shorter text is one shingle, one without words none."""
    h = word_hashes(words(text))
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = mixed(out * _MIX[0] + h[k : len(h) - n + 1 + k] + np.uint64(k))
    return np.unique(out)
