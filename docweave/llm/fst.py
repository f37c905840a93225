"""Weighted finite-state transducers: composition, and the best path of a word through one.

A transducer reads one symbol an arc and writes one. Weights add up along a
path, and the path of greatest weight counts; of equal ones that which comes
first by the order in which arcs were added.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator
from dataclasses import dataclass, field


@dataclass
class Fst:
    """arcs: state -> symbol read -> (symbol written, weight, next state); final: state -> weight of ending there."""

    start: Hashable
    arcs: dict[Hashable, dict[str, list[tuple[str, float, Hashable]]]] = field(default_factory=dict)
    final: dict[Hashable, float] = field(default_factory=dict)

    def arc(self, state: Hashable, read: str, write: str, to: Hashable, weight: float = 0.0) -> None:
        self.arcs.setdefault(state, {}).setdefault(read, []).append((write, weight, to))

    def paths(self, word: Iterable[str]) -> Iterator[tuple[float, str]]:
        """(weight, word written) of every path that reads the whole word."""
        symbols = list(word)

        def walk(state: Hashable, at: int, weight: float, out: str) -> Iterator[tuple[float, str]]:
            if at == len(symbols):
                if state in self.final:
                    yield weight + self.final[state], out
                return
            for write, w, to in self.arcs.get(state, {}).get(symbols[at], ()):
                yield from walk(to, at + 1, weight + w, out + write)

        return walk(self.start, 0, 0.0, "")

    def best(self, word: Iterable[str]) -> tuple[float, str] | None:
        """The path of greatest weight, by Viterbi's algorithm; none if the word isn't read."""
        held: dict[Hashable, tuple[float, str]] = {self.start: (0.0, "")}
        for symbol in word:
            ahead: dict[Hashable, tuple[float, str]] = {}
            for state, (weight, out) in held.items():
                for write, w, to in self.arcs.get(state, {}).get(symbol, ()):
                    if to not in ahead or weight + w > ahead[to][0]:
                        ahead[to] = (weight + w, out + write)
            held = ahead
        ends = [(w + self.final[s], out) for s, (w, out) in held.items() if s in self.final]
        return max(ends, key=lambda x: x[0], default=None)


def compose(first: Fst, second: Fst) -> Fst:
    """What first writes, second reads; states are pairs, and only those that can be reached are made."""
    out = Fst((first.start, second.start))
    todo, seen = [out.start], {out.start}
    while todo:
        a, b = state = todo.pop()
        if a in first.final and b in second.final:
            out.final[state] = first.final[a] + second.final[b]
        for read, ways in first.arcs.get(a, {}).items():
            for write, w, to in ways:
                for final, v, beyond in second.arcs.get(b, {}).get(write, ()):
                    out.arc(state, read, final, (to, beyond), w + v)
                    if (to, beyond) not in seen:
                        seen.add((to, beyond))
                        todo.append((to, beyond))
    return out
