"""Vectorised hashing of words and word shingles (used inside tasks).

Words are hashed by tabulation: the sum of one random 64-bit number per
(position, byte).  Equal words give equal hashes on every machine, since the
tables come from a fixed seed.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte but letters and digits parts words.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[:128] = True
PUNCTUATION[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32                       # A-Z to a-z, other bytes as they are
_POS = 256
_TABLE: np.ndarray | None = None
_U = np.uint64


def _table() -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        _TABLE = np.random.default_rng(20250101).integers(
            0, 2**64, size=(_POS * 256,), dtype=np.uint64)
    return _TABLE


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes], parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of words of each.

    A word is a run of bytes outside ``parts`` (space and 0x09-0x0D); A-Z
    count as a-z.  Runs over concatenated texts, so the cost per text is small."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    space = parts[data]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    at = np.flatnonzero(inside)
    which = np.cumsum(first)[at] - 1
    pos = at - starts[which]
    h = _table()[((pos & (_POS - 1)) << 8) + data[at]]
    far = pos >= _POS
    if far.any():
        h[far] *= (2 * (pos[far] // _POS) + 1).astype(np.uint64)
    heads = np.flatnonzero(first[at])
    return mix(np.add.reduceat(h, heads)), counts


def shingle_sets(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of one text; the
    whole sequence as one shingle when it is shorter; none without words."""
    n = len(words)
    if not n:
        return words
    k = min(size, n)
    h = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h = mix(h ^ words[j:n - k + 1 + j], j + 1)
    return np.unique(h)
