"""A trie of code sequences in two arrays, walked by many positions at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

ROOT = 0
# Places that are tried for a node at once, and windows of them before it goes
# behind all others. Nodes of fewer children than MANY are placed together, in so
# many rounds before the arrays grow.
TRIED, WINDOWS, MANY, ROUNDS = 64, 8, 32, 100


class DoubleArrayTrie:
    """State s goes by code c to ``base[s] + c`` if ``check`` there is s.

    Codes are from 1 on; 0 goes nowhere. ``accepts`` has for each state the
    number of the sequence that ends there, or -1.
    """

    def __init__(self, sequences: list[tuple[int, ...]]) -> None:
        longest = max(map(len, sequences), default=0)
        self._build(
            len(sequences),
            (np.array([s[k] if k < len(s) else 0 for s in sequences], np.int64) for k in range(longest)),
        )

    @classmethod
    def of_columns(cls, size: int, columns: Iterable[np.ndarray]) -> DoubleArrayTrie:
        """A trie of ``size`` sequences: their first codes, their second ones and so
        on, 0 behind the end of a sequence."""
        trie = cls.__new__(cls)
        trie._build(size, columns)
        return trie

    def _build(self, size: int, columns: Iterable[np.ndarray]) -> None:
        # The nodes level by level, and in a level by parent: children stand together.
        ends, at, total = np.full(size, ROOT, np.int32), np.arange(size, dtype=np.int32), 1
        parents, codes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for column in columns:
            at = at[column[at] > 0]
            if not len(at):
                break
            span = int(column.max()) + 1
            nodes, which = np.unique(ends[at].astype(np.int64) * span + column[at], return_inverse=True)
            ends[at] = total + which
            total += len(nodes)
            parents.append((nodes // span).astype(np.int32))
            codes.append((nodes % span).astype(np.int32))
            del nodes, which
        parents, codes = np.concatenate(parents), np.concatenate(codes)
        states = self._place(parents, codes, total)
        self.accepts = np.full(len(self.check), -1, np.int32)
        self.accepts[states[ends]] = np.arange(size)

    def _place(self, parents: np.ndarray, codes: np.ndarray, total: int) -> np.ndarray:
        """Gives every node a state: nodes with many children first, each at a base at
        which all of its children are free. ``parents`` and ``codes`` are those of
        the nodes from 1 on, ordered by parent."""
        sizes = np.bincount(parents, minlength=total).astype(np.int32)
        firsts = np.cumsum(sizes, dtype=np.int32) - sizes
        bases = np.zeros(total, np.int32)
        self._top = int(codes.max(initial=0))
        self._free = np.ones(2 * len(codes) + 2 * (self._top + TRIED), bool)
        self._free[ROOT] = False
        several = np.flatnonzero(sizes > 1)
        several = several[np.argsort(-sizes[several], kind="stable")]
        many = int(np.searchsorted(-sizes[several], -MANY, "right"))
        self._place_many(several[:many], sizes, firsts, codes, bases)
        random = np.random.default_rng(0)
        most = MANY
        while most > 2:  # nodes of 16 to 31 children, then 8 to 15 and so on
            least = most // 2
            held = several[(sizes[several] >= least) & (sizes[several] < most)]
            self._place_few(held, sizes, firsts, codes, bases, random)
            most = least
        # An only child takes any place.
        alone = np.flatnonzero(sizes == 1)
        places = np.flatnonzero(self._free)
        if len(places) < len(alone):
            self._grow(len(alone))
            places = np.flatnonzero(self._free)
        bases[alone] = places[: len(alone)] - codes[firsts[alone]]
        states = np.zeros(total, np.int32)
        states[1:] = bases[parents] + codes
        length = int(states.max()) + 1
        self.base, self.check = np.zeros(length, np.int32), np.full(length, -1, np.int32)
        self.base[states] = bases
        self.check[states[1:]] = states[parents]
        del self._free, self._top
        return states

    def _grow(self, cells: int) -> None:
        self._free = np.concatenate([self._free, np.ones(cells, bool)])

    def _place_many(self, nodes, sizes, firsts, codes, bases) -> None:
        """One after the other, each at the first base that fits. Where it takes too
        many windows to find one, the first of them counts as full, so that no part of
        the arrays is searched again and again."""
        low, end = 1, 1
        for node in nodes.tolist():
            own = codes[firsts[node] : firsts[node] + sizes[node]]
            spread = own - own[0]
            at = low
            for _ in range(WINDOWS):
                if at >= end:
                    break
                spots = at + np.flatnonzero(self._free[at : at + TRIED])
                spots = spots[self._free[spots[:, None] + spread[:8]].all(axis=1)]
                if len(spots):
                    spots = spots[self._free[spots[:, None] + spread].all(axis=1)]
                if len(spots):
                    break
                at += TRIED
            else:
                low += TRIED
                at = end
            place = int(spots[0]) if at < end else end
            self._free[place + spread] = False
            bases[node] = place - own[0]
            end = max(end, place + int(spread[-1]) + 1)
            if end + TRIED + self._top >= len(self._free):
                self._grow(len(self._free))

    def _place_few(self, nodes, sizes, firsts, codes, bases, random) -> None:
        """All of them together: every node tries a random place, and again until
        it meets neither a child that has its place nor one of another node."""
        owners = np.zeros(0, np.int32)
        tries = 0
        while len(nodes):
            if tries == ROUNDS:
                self._grow(len(self._free) // 2)
                tries = 0
            tries += 1
            if len(owners) != len(self._free):
                owners = np.zeros(len(self._free), np.int32)
            size = sizes[nodes]
            of = np.repeat(np.arange(len(nodes)), size)
            starts = np.cumsum(size) - size
            own = codes[np.arange(len(of)) - np.repeat(starts, size) + np.repeat(firsts[nodes], size)]
            first = own[starts]
            spots = random.integers(1, len(self._free) - self._top, len(nodes))
            places = (spots - first)[of] + own
            # The last of those that want a place owns it.
            good = np.logical_and.reduceat(self._free[places], starts)
            want = good[of]
            owners[places[want]] = of[want]
            good &= np.logical_and.reduceat(~want | (owners[places] == of), starts)
            self._free[places[good[of]]] = False
            bases[nodes[good]] = (spots - first)[good]
            nodes = nodes[~good]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of every position, -1 where there is none."""
        places = self.base[states] + codes
        good = (codes > 0) & (places >= 0) & (places < len(self.check))
        places = np.where(good, places, 0)
        return np.where(good & (self.check[places] == states), places, -1)
