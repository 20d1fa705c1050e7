"""Signature trees over small sets, in numpy.

A tree's leaves are sets, in an order that puts sets with common tokens side by
side; every node above holds the OR of its children's token bitmaps, the range
of their sizes and what they have in common (component, side). Two trees, or a
tree with itself, are traversed together from the roots. A pair of nodes is
dropped if no two sizes can reach the similarity, if all its pairs are known to be
connected, if no prefix token can be shared, or if the largest possible overlap
of two of its sets is less than their sizes need. What is left of the leaf pairs
passes a bound on the symmetric difference.

Largest possible overlap: a set's bitmap over all its tokens has a bit where an odd
number of them falls (its parity sketch, folded to ``WORDS`` words). A bit that one
set has and the other lacks is a token that they do not share. A set below node A has at
least ``fewest`` bits, of which at most the common bits of A's and B's OR bitmaps can
be in a set below B; the same holds the other way round. What is left on both sides
cannot be shared. A wide node's bitmap is nearly full and drops little; near the
leaves, and between groups of near copies, the bound is sharp.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 8
WORDS = 8                  # 64-bit words of a token bitmap
LEAF_PAIRS = 1 << 12       # node pairs expanded at a time
MIXED = np.iinfo(np.int64).min


@dataclass
class Level:
    bitmap: np.ndarray     # [nodes, WORDS], prefix tokens
    whole: np.ndarray      # [nodes, WORDS], all tokens (parities at the leaves, their OR above)
    fewest: np.ndarray     # least number of bits of a set below
    low: np.ndarray        # sizes
    high: np.ndarray
    component: np.ndarray  # MIXED where children differ
    side: np.ndarray       # 0 or 1, MIXED where children differ


def _uniform(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
    return np.where(low == high, low, MIXED)


def build(bitmap: np.ndarray, whole: np.ndarray, sizes: np.ndarray, component: np.ndarray,
          side: np.ndarray) -> list[Level]:
    """Levels from the leaves (one per set) to the root."""
    fewest = np.bitwise_count(whole).sum(axis=1).astype(np.int64)
    levels = [Level(bitmap, whole, fewest, sizes, sizes, component, side)]
    while len(levels[-1].low) > 1:
        below = levels[-1]
        starts = np.arange(0, len(below.low), FAN)
        levels.append(Level(
            np.bitwise_or.reduceat(below.bitmap, starts, axis=0),
            np.bitwise_or.reduceat(below.whole, starts, axis=0), np.minimum.reduceat(below.fewest, starts),
            np.minimum.reduceat(below.low, starts), np.maximum.reduceat(below.high, starts),
            _uniform(below.component, starts), _uniform(below.side, starts)))
    return levels


def _possible(level: Level, a: np.ndarray, b: np.ndarray, percent: int, crossing: bool) -> np.ndarray:
    """Node pairs that may hold a wanted pair of sets."""
    keep = ((level.high[a] * 100 >= percent * level.low[b])
            & (level.high[b] * 100 >= percent * level.low[a])
            & ((level.component[a] != level.component[b]) | (level.component[a] == MIXED)))
    if crossing:
        keep &= (level.side[a] != level.side[b]) | (level.side[a] == MIXED)
    at = np.flatnonzero(keep)
    at = at[(level.bitmap[a[at]] & level.bitmap[b[at]]).any(axis=1)]
    a, b = a[at], b[at]
    # With s tokens in both sets together, the largest overlap is (s - unshared) / 2 and
    # the least that is needed percent s / (100 + percent).
    both = level.high[a] + level.high[b]
    return at[(100 + percent) * (both - unshared(level, a, b)) >= 2 * percent * both]


def unshared(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fewest tokens of a set below node a and of one below node b, together, that
    the two cannot share."""
    common = np.bitwise_count(level.whole[a] & level.whole[b]).sum(axis=1).astype(np.int64)
    return np.maximum(level.fewest[a] - common, 0) + np.maximum(level.fewest[b] - common, 0)


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Fewest common tokens of sets of sizes n and m at the similarity
    ``percent`` / 100: 100 i >= percent (n + m - i) for the intersection i."""
    return -(-percent * (n + m) // (100 + percent))


def _children(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All child pairs of node pairs (a <= b), each unordered pair once."""
    step = np.arange(FAN)
    left = np.repeat(a[:, None] * FAN + step, FAN, axis=1).ravel()
    right = np.tile(b[:, None] * FAN + step, (1, FAN)).ravel()
    keep = (left < count) & (right < count) & (left <= right)
    return left[keep], right[keep]


def pairs(levels: list[Level], percent: int, crossing: bool):
    """Yields arrays (i, j) of leaf pairs, i < j, that the traversal leaves."""
    def descend(depth: int, a: np.ndarray, b: np.ndarray):
        at = _possible(levels[depth], a, b, percent, crossing)
        a, b = a[at], b[at]
        if depth == 0:
            different = a != b
            if different.any():
                yield a[different], b[different]
            return
        for s in range(0, len(a), LEAF_PAIRS):
            yield from descend(depth - 1, *_children(
                a[s:s + LEAF_PAIRS], b[s:s + LEAF_PAIRS], len(levels[depth - 1].low)))

    if levels and len(levels[0].low) > 1:
        yield from descend(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))


def most_difference(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Largest symmetric difference of sets of sizes n and m at the similarity."""
    return n + m - 2 * least_overlap(n, m, percent)


class Parities:
    """Parity sketches of different widths. Bit h mod width is the parity of the
    tokens with that value, so the XOR of two sketches has at most as many bits
    as the symmetric difference has tokens. A wider sketch folds to half its
    width by XOR of its halves."""

    def __init__(self, sketches: list[bytes]) -> None:
        self.width = np.fromiter(map(len, sketches), np.int64, len(sketches))
        self.rows: dict[int, np.ndarray] = {}
        self.at = np.zeros(len(sketches), np.int64)
        for width in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == width)
            self.at[own] = np.arange(len(own))
            self.rows[width] = np.frombuffer(b"".join(sketches[i] for i in own.tolist()),
                                             np.uint64).reshape(len(own), -1)

    def _folded(self, at: np.ndarray, width: int, to: int) -> np.ndarray:
        rows = self.rows[width][self.at[at]]
        while width > to:
            half = rows.shape[1] // 2
            rows, width = rows[:, :half] ^ rows[:, half:], width // 2
        return rows

    def bitmaps(self) -> np.ndarray:
        """All sketches, [sets, WORDS], folded to one width: the narrowest of them, and
        ``WORDS`` words at most."""
        to = min(8 * WORDS, int(self.width.min(initial=8 * WORDS)))
        out = np.zeros((len(self.width), WORDS), np.uint64)
        for width in self.rows:
            own = np.flatnonzero(self.width == width)
            out[own, :to // 8] = self._folded(own, width, to)
        return out

    def least_difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A lower bound of the symmetric difference of each pair."""
        out = np.empty(len(a), np.int64)
        widths = self.width[a] << 32 | self.width[b]
        for both in np.unique(widths).tolist():
            wa, wb = both >> 32, both & 0xFFFFFFFF
            own = np.flatnonzero(widths == both)
            for s in range(0, len(own), 1 << 14):
                part = own[s:s + (1 << 14)]
                x = self._folded(a[part], wa, min(wa, wb)) ^ self._folded(b[part], wb, min(wa, wb))
                out[part] = np.bitwise_count(x).sum(axis=1)
        return out


def parity_sketch(tokens: np.ndarray, bits: int) -> bytes:
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def candidates(tokens: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, component: np.ndarray,
               side: np.ndarray, sketches: list[bytes], percent: int, crossing: bool
               ) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs (smaller first) of rows (token, node, ...) that share a token,
    are not of one component, and may reach the similarity."""
    leaf, first, back = np.unique(nodes, return_index=True, return_inverse=True)
    lowest = np.full(len(leaf), np.iinfo(np.int64).max)
    np.minimum.at(lowest, back, tokens)
    order = np.lexsort((sizes[first], lowest, side[first]))
    place = np.empty(len(leaf), np.int64)
    place[order] = np.arange(len(leaf))
    bitmap = np.zeros((len(leaf), WORDS), np.uint64)
    bit = (tokens.view(np.uint64) >> np.uint64(7)) % np.uint64(64 * WORDS)
    np.bitwise_or.at(bitmap, (place[back], (bit // np.uint64(64)).astype(np.int64)),
                     np.uint64(1) << (bit % np.uint64(64)))
    first = first[order]
    parity = Parities([sketches[i] for i in first.tolist()])
    n, ids = sizes[first], nodes[first]
    whole = parity.bitmaps()
    found_a, found_b = [], []
    for a, b in pairs(build(bitmap, whole, n, component[first], side[first]), percent, crossing):
        for s in range(0, len(a), 1 << 18):
            x, y = a[s:s + (1 << 18)], b[s:s + (1 << 18)]
            near = parity.least_difference(x, y) <= most_difference(n[x], n[y], percent)
            found_a.append(ids[x[near]])
            found_b.append(ids[y[near]])
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    return np.minimum(a, b), np.maximum(a, b)
