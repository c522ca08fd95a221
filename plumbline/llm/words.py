"""Words of many texts at once, as hashes: no Python object per word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from plumbline.llm.common import mixed

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd, so that every power has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(n: int, inverse: bool) -> np.ndarray:
    out = np.full(n, _INVERSE if inverse else BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE to the power 0 .. n-1, or its inverses, modulo 2**64."""
    size = 1 << max(10, (n - 1).bit_length())
    return _powers(size, inverse)[:n]


def _byte_values(fold: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold``, A-Z have those of a-z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    return values[_LOWER] if fold else values


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}


def word_hashes(data: np.ndarray, at: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words before each text.

    A word is a run of bytes other than blanks; it never crosses texts. The hash is a
    polynomial of its bytes, taken from prefix sums and shifted back to power 0.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    solid = ~_IS_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    edges = at[(at > 0) & (at < len(data))]
    begins[edges] = solid[edges]
    ends[edges - 1] = solid[edges - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    terms = _VALUES[fold][data]
    terms *= powers(len(data))
    sums = np.cumsum(terms, dtype=np.uint64)
    before = np.where(first > 0, sums[first - 1], np.uint64(0))
    h = (sums[last] - before) * powers(len(data), inverse=True)[first]
    return mixed(h + (last - first).astype(np.uint64)), np.searchsorted(first, at)


def rolling_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``length`` words, by the word it starts at."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(len(words)), dtype=np.uint64)])
    return mixed((sums[length:] - sums[:n]) * powers(len(words), inverse=True)[:n])


def whole_windows(first: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` words lie inside one text; ``first`` as from ``word_hashes``."""
    n = int(first[-1]) - length + 1
    inside = np.ones(max(n, 0), bool)
    for edge in (first[1:-1] if n > 0 else ()):
        inside[max(0, edge - length + 1) : edge] = False
    return inside
