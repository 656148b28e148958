"""Recompression: a run-length grammar of many texts, and longest common
extensions on it.

A string of symbols is rewritten level by level: *block compression* turns each
maximal run of one symbol into one (a rule ``symbol ^ count``), *pair
compression* splits the alphabet in two by a seeded hash and turns each pair
"left symbol, right symbol" into one. Both read nothing but the symbols
themselves, so equal stretches are rewritten alike but for their ends, and each
pair level takes about a quarter of what is left.

The longest common extension of two places climbs the levels while both places
begin a symbol there, comparing only the symbols it has to step over, and comes
down again to the first difference: a few steps a level, done for all queries
at a time. Extensions to the left run on the mirrored levels.

Symbols below zero are separators: each occurs once and is never rewritten, so
no extension goes beyond one. A string starts and ends with a separator.
"""

from __future__ import annotations

import numpy as np

from .blocks import mix

MOST_LEVELS = 200


def _renamed(keys: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """Symbols numbered by *keys*; those under zero in *fixed* stay."""
    out = fixed.copy()
    free = fixed >= 0
    _, out[free] = np.unique(keys[free], return_inverse=True)
    return out


class Grammar:
    """The levels of one string: per level its symbols, whether each begins a
    symbol of the next level, and whether the step to there packs blocks."""

    def __init__(self, symbols: np.ndarray):
        levels = []
        t = symbols.astype(np.int64)
        while len(levels) < MOST_LEVELS:
            walls = np.flatnonzero(t < 0)
            if len(walls) < 2 or np.diff(walls).max() <= 3:
                break
            blocks = len(levels) % 2 == 0
            if blocks:
                head = np.append(True, t[1:] != t[:-1])
                first = np.flatnonzero(head)
                count = np.diff(np.append(first, len(t)))
                following = _renamed(t[first] * (int(count.max()) + 1) + count, np.minimum(t[first], 0))
            else:
                side = (mix(t.view(np.uint64) + np.uint64(len(levels) << 40)) >> np.uint64(63)).astype(bool)
                joined = np.append(side[:-1] & ~side[1:] & (t[:-1] >= 0) & (t[1:] >= 0), False)
                head = np.append(True, ~joined[:-1])
                first = np.flatnonzero(head)
                second = np.where(joined[first], t[np.minimum(first + 1, len(t) - 1)] + 1, 0)
                following = _renamed(t[first] * (int(t.max()) + 2) + second, np.minimum(t[first], 0))
            levels.append((t, head, blocks))
            t = following
        self.length = len(symbols)
        self.right = self._side(levels, t)
        self.left = self._side([(x[::-1], np.append(head[1:], True)[::-1], blocks) for x, head, blocks in levels], t[::-1])

    @staticmethod
    def _side(levels, top):
        side = []
        for t, head, blocks in levels:
            first = np.flatnonzero(head)
            parent = np.cumsum(head) - 1
            # Symbols left to the end of the block; pairs are stepped one by one.
            step = np.append(first[1:], len(t))[parent] - np.arange(len(t)) if blocks else None
            side.append((np.ascontiguousarray(t), head, parent.astype(np.int32), first.astype(np.int32), step))
        side.append((np.ascontiguousarray(top), None, None, None, None))
        return side

    def extend_right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols from x and y on are equal (x and y differ)."""
        return self._extend(self.right, x, y)

    def extend_left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols before x and y are equal."""
        return self._extend(self.left, self.length - x, self.length - y)

    @staticmethod
    def _extend(levels, x, y):
        u, v = x.astype(np.int64), y.astype(np.int64)
        stop = np.full(len(u), -1)
        live = np.arange(len(u))
        for number, (t, head, parent, _, step) in enumerate(levels):
            open_ = live if head is None else live[~(head[u[live]] & head[v[live]])]
            while len(open_):
                same = t[u[open_]] == t[v[open_]]
                stop[open_[~same]] = number
                open_ = open_[same]
                move = 1 if step is None else np.minimum(step[u[open_]], step[v[open_]])
                u[open_] += move
                v[open_] += move
                if head is not None:
                    open_ = open_[~(head[u[open_]] & head[v[open_]])]
            if head is None:
                break
            live = live[stop[live] < 0]
            u[live], v[live] = parent[u[live]], parent[v[live]]
        for number in range(len(levels) - 2, -1, -1):
            t, _, _, _, step = levels[number]
            first = levels[number][3]
            down = np.flatnonzero(stop > number)
            u[down], v[down] = first[u[down]], first[v[down]]
            while len(down):
                down = down[t[u[down]] == t[v[down]]]
                move = 1 if step is None else np.minimum(step[u[down]], step[v[down]])
                u[down] += move
                v[down] += move
        return u - x
