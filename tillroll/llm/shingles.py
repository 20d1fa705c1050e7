"""Word-shingle sets of whole texts as sorted 64-bit hashes, in numpy.

Words are runs of bytes other than blank and 0x09-0x0D, with A-Z lower-cased.
Equal shingles are equal hashes; unequal ones share a hash with chance 2**-64.
"""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64)]


def _powers(count: int) -> np.ndarray:
    if len(_POWERS[0]) < count:
        grown = np.full(1 << (count - 1).bit_length(), _BASE, np.uint64)
        grown[0] = 1
        _POWERS[0] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS[0]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    letters = np.frombuffer(raw, np.uint8)
    inside = ~_BLANK[letters]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    flat = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = _powers(int(lengths.max()))
    sums = np.add.reduceat(_LOWER[letters[inside]] * powers[flat], np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct hashes of all runs of ``words`` words, sorted; of a shorter text
    with words, one hash of the whole sequence; empty without words."""
    h = word_hashes((text or "").encode())
    n = len(h)
    if n == 0:
        return h
    run = min(words, n)
    # The seed tells a short whole sequence from a run of the same words.
    out = np.full(n - run + 1, 0 if n >= words else n, np.uint64)
    for i in range(run):
        out = mix(out * _BASE + h[i:n - run + 1 + i])
    return np.unique(out)
