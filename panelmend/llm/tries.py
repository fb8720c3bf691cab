"""Double-array tries over byte strings, built and walked many keys at a time in numpy.

A state is a cell; the child of state ``s`` by byte ``c`` is the cell ``base[s] + c`` if its
``check`` is ``s``. ``accept`` numbers the states that end a key by the key's rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Cells before the first one that may be used, so that no base is negative.
MARGIN = 256
ROOT = MARGIN
#: States with more children than this are placed one by one.
MANY = 12


@dataclass
class Trie:
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    ends: np.ndarray  # state of each key, by rank

    def walk(self, key: bytes, state: int = ROOT) -> int:
        """The state after ``key``, or -1."""
        for c in key:
            cell = int(self.base[state]) + c
            if self.check[cell] != state:
                return -1
            state = cell
        return state

    def spelled(self, ranks: np.ndarray) -> list[bytes]:
        """The keys of these ranks, read from their states up to the root."""
        state = self.ends[ranks].astype(np.int64)
        letters = []
        while (state != ROOT).any():
            up = np.where(state == ROOT, ROOT, self.check[state])
            letters.append(np.where(state == ROOT, -1, state - self.base[up]))
            state = up
        if not letters:
            return [b""] * len(ranks)
        table = np.stack(letters[::-1], axis=1)
        return [row[row >= 0].astype(np.uint8).tobytes() for row in table]


class _Cells:
    """Cells while a trie grows; ``check`` is -1 where a cell is free."""

    def __init__(self) -> None:
        self.check = np.full(4 * MARGIN, -1, dtype=np.int32)
        self.base = np.zeros(4 * MARGIN, dtype=np.int32)
        self.check[:MARGIN + 1] = -2
        self.top = MARGIN + 1  # no cell from here on is taken
        self.rng = np.random.default_rng(12)

    def upto(self, size: int) -> None:
        if size + 2 * MARGIN > len(self.check):
            more = max(size + 2 * MARGIN, len(self.check) * 3 // 2) - len(self.check)
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int32)])
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int32)])

    def take(self, cells: np.ndarray, parents: np.ndarray) -> None:
        self.check[cells] = parents
        self.top = max(self.top, int(cells.max()) + 1)

    def alone(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Only children go to the lowest free cells."""
        self.upto(self.top + len(parents))
        cells = np.flatnonzero(self.check[:self.top + len(parents)] == -1)[:len(parents)]
        self.base[parents] = cells - symbols
        self.take(cells, parents)
        return cells

    def spread(self, parents: np.ndarray, counts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Families of several children: all try places at random, those without conflict stay."""
        which = np.repeat(np.arange(len(parents)), counts)
        cells = np.zeros(len(symbols), dtype=np.int64)
        low, open_ = self.top, np.arange(len(parents))
        high = low + 2 * len(symbols)
        todo = np.arange(len(symbols))
        while len(open_):
            self.upto(high + MARGIN)
            base = np.zeros(len(parents), dtype=np.int64)
            base[open_] = self.rng.integers(low, high, len(open_)) - MARGIN // 2
            want = base[which[todo]] + symbols[todo]
            _, first = np.unique(want, return_index=True)
            fits = np.zeros(len(todo), dtype=bool)
            fits[first] = True
            fits &= self.check[want] == -1
            bad = np.zeros(len(parents), dtype=bool)
            bad[which[todo[~fits]]] = True
            good = ~bad[which[todo]]
            if good.any():
                at = todo[good]
                cells[at] = want[good]
                self.take(cells[at], parents[which[at]])
                placed = open_[~bad[open_]]
                self.base[parents[placed]] = base[placed]
            if good.mean() < 0.25:
                high += 2 * len(todo) + MARGIN
            todo, open_ = todo[~good], open_[bad[open_]]
        return cells

    def family(self, parent: int, symbols: np.ndarray) -> np.ndarray:
        """A family of many children behind all taken cells."""
        self.upto(self.top + MARGIN)
        base = self.top - int(symbols[0])
        self.base[parent] = base
        self.take(base + symbols, np.full(len(symbols), parent))
        return base + symbols


def build(data: np.ndarray, offsets: np.ndarray) -> Trie:
    """The trie of sorted distinct keys: their bytes one after another, and n + 1 offsets.

    Grown level by level; every level's families are placed together.
    """
    cells, lengths = _Cells(), np.diff(offsets)
    at = np.full(len(lengths), ROOT, dtype=np.int64)
    live, depth = np.flatnonzero(lengths > 0), 0
    while len(live):
        symbol = data[offsets[live] + depth].astype(np.int64)
        parent = at[live]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        parents, symbols = parent[first], symbol[first]
        head = np.ones(len(first), dtype=bool)
        head[1:] = parents[1:] != parents[:-1]
        begin = np.flatnonzero(head)
        count = np.diff(np.append(begin, len(first)))
        size = np.repeat(count, count)
        place = np.zeros(len(first), dtype=np.int64)
        for b, n in zip(begin[count > MANY].tolist(), count[count > MANY].tolist()):
            place[b:b + n] = cells.family(int(parents[b]), symbols[b:b + n])
        some = (size > 1) & (size <= MANY)
        if some.any():
            kept = (count > 1) & (count <= MANY)
            place[some] = cells.spread(parents[begin[kept]], count[kept], symbols[some])
        if (size == 1).any():
            place[size == 1] = cells.alone(parents[size == 1], symbols[size == 1])
        at[live] = place[np.cumsum(new) - 1]
        depth += 1
        live = live[lengths[live] > depth]
    upto = cells.top + MARGIN + 1
    cells.upto(upto)
    accept = np.full(upto, -1, dtype=np.int32)
    accept[at] = np.arange(len(at), dtype=np.int32)
    return Trie(cells.base[:upto], cells.check[:upto], accept, at.astype(np.int32))
