"""Weighted finite-state transducers over word classes, their composition and best paths."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass, field

#: A state, the symbol written, and how an arc changes the value that its symbol carries: value * factor + bonus.
Arc = tuple[Hashable, int, float, float]


@dataclass
class Transducer:
    """``arcs(state, symbol)`` lists the arcs of a state; a path that has none dies. ``final(state)`` tells whether a path may end there."""

    start: Hashable
    arcs: Callable[[Hashable, int], list[Arc]]
    final: Callable[[Hashable], bool] = field(default=lambda state: True)

    def after(self, other: Transducer) -> Transducer:
        """The composition: what ``other`` writes, this one reads."""

        def arcs(state: Hashable, symbol: int) -> list[Arc]:
            p, q = state
            return [((p2, q2), z, f * g, c * g + d) for p2, y, f, c in other.arcs(p, symbol) for q2, z, g, d in self.arcs(q, y)]

        return Transducer((other.start, self.start), arcs, lambda s: other.final(s[0]) and self.final(s[1]))


class Table:
    """All reachable states of a transducer, numbered, with their arcs for each symbol: (next, factor, bonus)."""

    def __init__(self, machine: Transducer, symbols: Iterable[int]):
        symbols = list(symbols)
        number = {machine.start: 0}
        states = [machine.start]
        self.arcs: list[list[list[tuple[int, float, float]]]] = []
        for state in states:  # grows while it is read
            row = []
            for symbol in symbols:
                out = []
                for to, _, factor, bonus in machine.arcs(state, symbol):
                    if to not in number:
                        number[to] = len(states)
                        states.append(to)
                    out.append((number[to], factor, bonus))
                row.append(out)
            self.arcs.append(row)
        self.final = [machine.final(s) for s in states]

    def best(self, read: list[tuple[int, float]]) -> float:
        """The highest weight of an accepted path over (symbol, value) pairs: the sum of its values; 0 if no path is accepted."""
        live = {0: 0.0}
        arcs = self.arcs
        for symbol, value in read:
            now: dict[int, float] = {}
            for state, weight in live.items():
                for to, factor, bonus in arcs[state][symbol]:
                    w = weight + value * factor + bonus
                    if w > now.get(to, -1e300):
                        now[to] = w
            live = now
        return max((w for s, w in live.items() if self.final[s]), default=0.0)
