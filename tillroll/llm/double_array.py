"""Double-array tries over sorted sequences of dense ids, in numpy.

The child of state ``s`` under id ``c`` is ``t = BASE[s] + c`` if ``CHECK[t] == s``.
States are placed level by level: an only child takes the first free place, more
children the first base at which all their places are free.
"""

from __future__ import annotations

import numpy as np

FREE, ROOT = -1, -2


class DoubleArray:
    """``codes``: the dense ids of all sequences, one behind another; sequence i
    has ``lengths[i]`` of them. ``depth_of`` gives every state's depth."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray) -> None:
        self.codes, self.lengths = codes, lengths
        self.first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.base = np.zeros(16, np.int64)
        self.check = np.full(16, FREE, np.int64)
        self.check[0] = ROOT
        self.low = 1
        self._build()

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            size = max(size, 2 * len(self.check))
            more = size - len(self.check)
            self.check = np.concatenate([self.check, np.full(more, FREE, np.int64)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])

    def _free(self) -> np.ndarray:
        free = self.low + np.flatnonzero(self.check[self.low:] == FREE)
        self.low = int(free[0]) if len(free) else len(self.check)
        return free

    def _place_only_children(self, parents: np.ndarray, codes: np.ndarray) -> None:
        self._grow(self.low + 1)
        while len(free := self._free()) < len(parents):
            self._grow(2 * len(self.check) + len(parents))
        at = free[:len(parents)]
        self.base[parents] = at - codes
        self.check[at] = parents

    def _place_children(self, parent: int, codes: np.ndarray) -> None:
        apart = codes - codes[0]
        self._grow(self.low + int(apart[-1]) + 2)
        free = self._free()
        free = np.append(free, len(self.check))     # behind the end all places are free
        step = max(1, 1_000_000 // len(codes))
        for i in range(0, len(free), step):
            at = free[i:i + step, None] + apart
            inside = at < len(self.check)
            taken = inside & (self.check[np.where(inside, at, 0)] != FREE)
            fits = np.flatnonzero(~taken.any(axis=1))
            if len(fits):
                places = at[fits[0]]
                break
        self._grow(int(places[-1]) + 1)
        self.base[parent] = places[0] - codes[0]
        self.check[places] = parent

    def _build(self) -> None:
        state = np.zeros(len(self.lengths), np.int64)
        k, alive = 0, np.flatnonzero(self.lengths > 0)
        while len(alive):
            code = self.codes[self.first[alive] + k]
            order = np.lexsort((code, state[alive]))
            parents, codes = state[alive][order], code[order]
            fresh = np.concatenate([[True], (parents[1:] != parents[:-1]) | (codes[1:] != codes[:-1])])
            parents, codes = parents[fresh], codes[fresh]
            starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
            sizes = np.diff(np.append(starts, len(parents)))
            for start, size in zip(starts[sizes > 1], sizes[sizes > 1]):
                self._place_children(int(parents[start]), codes[start:start + size])
            only = starts[sizes == 1]
            if len(only):
                self._place_only_children(parents[only], codes[only])
            state[alive] = self.base[state[alive]] + code
            k += 1
            alive = alive[self.lengths[alive] > k]

    def walk(self):
        """Yields (depth, sequences that reach it, their states), from depth 0.
        Every step is looked up in BASE and checked in CHECK."""
        alive = np.arange(len(self.lengths))
        state = np.zeros(len(alive), np.int64)
        k = 0
        while len(alive):
            yield k, alive, state
            further = self.lengths[alive] > k
            alive, state = alive[further], state[further]
            at = self.base[state] + self.codes[self.first[alive] + k]
            if not (self.check[at] == state).all():
                raise AssertionError("a sequence is not in its trie")
            state = at
            k += 1
