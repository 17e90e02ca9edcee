"""Recompression of a sequence into a run-length grammar, and longest common extensions on it, in numpy.

Levels alternate: a block level makes one symbol of each stretch of the same symbol, a pair level one of each left
symbol followed by a right one, where a hash of the symbol says which it is. What a stretch becomes depends on it and
its direct neighbours alone, so equal stretches are parsed alike but for their ends. An extension query therefore
climbs while two places agree, taking at most one symbol or one block's rest on each level, and goes down again from
the level where they differ: a step or two on each level, whatever its length. Many queries climb at once.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Grammar:
    """The grammar of a sequence of symbols 0..n-1. Queries must end before its ends: see ``extension``."""

    def __init__(self, sequence: np.ndarray) -> None:
        self.symbols = [sequence.astype(np.int64)]
        self.names = int(sequence.max(initial=-1)) + 1
        #: For each level but the first: whether it has blocks, the first and last child of each symbol; and for each
        #: level but the last the parent of each symbol.
        self.blocks: list[bool] = []
        self.first: list[np.ndarray] = []
        self.last: list[np.ndarray] = []
        self.parent: list[np.ndarray] = []
        salt = 0
        while len(self.symbols[-1]) > 1:
            self._add_blocks()
            salt += 1
            if len(self.symbols[-1]) > 1:
                self._add_pairs(salt)

    def _add(self, blocks: bool, begins: np.ndarray, symbols: np.ndarray) -> None:
        first = np.flatnonzero(begins)
        self.blocks.append(blocks)
        self.first.append(first)
        self.last.append(np.append(first[1:], len(begins)) - 1)
        self.parent.append(np.cumsum(begins) - 1)
        self.symbols.append(symbols)

    def _named(self, symbols: np.ndarray, where: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The symbols, those at ``where`` under new names, the same for the same code."""
        distinct, name = np.unique(codes, return_inverse=True)
        symbols[where] = self.names + name
        self.names += len(distinct)
        return symbols

    def _add_blocks(self) -> None:
        below = self.symbols[-1]
        begins = np.append(True, below[1:] != below[:-1])
        if begins.all():
            return
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(below)))
        many = np.flatnonzero(size > 1)
        symbols = below[first]
        self._add(True, begins, self._named(symbols, many, symbols[many] * (int(size.max()) + 1) + size[many]))

    def _add_pairs(self, salt: int) -> None:
        below = self.symbols[-1]
        mixed = (below.astype(np.uint64) + np.uint64(salt * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)) * _ODD
        left = ((mixed ^ (mixed >> np.uint64(31))) * _ODD >> np.uint64(63)).astype(bool)
        one, other = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        paired = one if one.sum() >= other.sum() else other
        if not paired.any():
            return
        begins = np.append(True, ~paired)
        where = np.flatnonzero(paired)
        symbols = below[begins]
        parents = np.cumsum(begins) - 1
        self._add(False, begins, self._named(symbols, parents[where], below[where] * self.names + below[where + 1]))

    def extension(self, x: np.ndarray, y: np.ndarray, step: int = 1) -> np.ndarray:
        """How many symbols from x and y on are the same, going right (``step`` 1, x and y included) or left (-1).

        x must differ from y, and between the places and the end of the sequence that they go to must stand a symbol
        that occurs nowhere else, for each pair.
        """
        begin = x
        near, far = (self.first, self.last) if step == 1 else (self.last, self.first)
        stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        query = np.arange(len(x))
        for level, symbols in enumerate(self.symbols):
            same = symbols[x] == symbols[y]
            if level == len(self.parent):
                stopped.append((query, x, y))
                break
            up_x, up_y = self.parent[level][x], self.parent[level][y]
            if self.blocks[level]:
                left_x, left_y = np.abs(far[level][up_x] - x) + 1, np.abs(far[level][up_y] - y) + 1
                taken = np.where(same, np.minimum(left_x, left_y), 0)
                climbs = same & (left_x == left_y)
                next_x, next_y = up_x + step, up_y + step
            else:
                edge = (near[level][up_x] == x) & (near[level][up_y] == y)
                climbs, taken = edge | same, 0
                next_x, next_y = np.where(edge, up_x, up_x + step), np.where(edge, up_y, up_y + step)
                # Past the inner symbol of a pair, or a symbol that is a whole parent, lies the next parent.
            stays = ~climbs
            stopped.append((query[stays], (x + step * taken)[stays], (y + step * taken)[stays]))
            query, x, y = query[climbs], next_x[climbs], next_y[climbs]
            if not len(query):
                break
        out = np.empty(len(begin), dtype=np.int64)
        query = x = y = np.empty(0, dtype=np.int64)
        for level in reversed(range(len(stopped))):
            query, x, y = (np.concatenate([a, b]) for a, b in zip((query, x, y), stopped[level]))
            if level:
                x, y = self._down(level - 1, x, y, step, near, far)
        out[query] = np.abs(x - begin[query])
        return out

    def _down(self, level: int, x: np.ndarray, y: np.ndarray, step: int, near: list, far: list) -> tuple[np.ndarray, np.ndarray]:
        """From places that differ one level above to the first that differ here."""
        to_x, to_y = near[level][x], near[level][y]
        same = self.symbols[level][to_x] == self.symbols[level][to_y]
        taken = 1
        if self.blocks[level]:
            taken = np.minimum(np.abs(far[level][x] - to_x), np.abs(far[level][y] - to_y)) + 1
        taken = np.where(same, taken, 0) * step
        return to_x + taken, to_y + taken
