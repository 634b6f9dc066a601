"""Small weighted finite-state transducers over word classes, and their composition.

A transducer reads the classes of a clause's words one by one. Context transducers only remember: a target, a negation or
reported speech before a word, for a number of words or to the end of the clause. An emitting transducer writes one
symbol for each insult or threat it reads. The composition runs them side by side as one table of states, in which what
is written carries the context it was written in.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLASSES = 6
MODES = ("plain", "targeted", "negated", "reported", "negated and reported")


@dataclass(frozen=True)
class Context:
    """A transducer with a counter for a state: reading ``opens`` sets it to ``reach``, any other word lowers it.

    A reach of 0 stands for the rest of the clause.
    """
    opens: int
    reach: int

    @property
    def states(self) -> int:
        return 2 if self.reach == 0 else self.reach + 1

    def step(self, state: int, symbol: int) -> int:
        if symbol == self.opens:
            return max(1, self.reach)
        return state if self.reach == 0 else max(0, state - 1)


#: A target reaches five words on ("you are such an ..."), a negation three, reported speech to the end.
TARGETED, NEGATED, REPORTED = Context(TARGET, 5), Context(NEGATION, 3), Context(REPORT, 0)


def _mode(target: int, negation: int, report: int) -> int:
    if report:
        return 4 if negation else 3
    return 2 if negation else int(bool(target))


class Grammar:
    """The composition: ``next_state[state, symbol]`` and ``output[state, symbol]`` (0, or 1 + an index of a match).

    A match is a pair of kind (insult, threat) and mode; ``matches`` counts them.
    """

    matches = 2 * len(MODES)

    def __init__(self, target: Context = TARGETED, negation: Context = NEGATED, report: Context = REPORTED):
        parts = (target, negation, report)
        start = (0, 0, 0)
        number = {start: 0}
        rows: list[list[int]] = []
        out: list[list[int]] = []
        for state in (queue := [start]):
            rows.append([])
            out.append([])
            for symbol in range(CLASSES):
                after = tuple(p.step(s, symbol) for p, s in zip(parts, state, strict=True))
                if after not in number:
                    number[after] = len(queue)
                    queue.append(after)
                rows[-1].append(number[after])
                kind = {INSULT: 0, THREAT: 1}.get(symbol)
                out[-1].append(0 if kind is None else 1 + kind * len(MODES) + _mode(*state))
        self.next_state, self.output = np.array(rows), np.array(out)

    def scan(self, symbols: list[int], weights: list[float]) -> np.ndarray:
        """Weight written for each match of one clause."""
        found, state = np.zeros(self.matches), 0
        for symbol, weight in zip(symbols, weights, strict=True):
            if o := self.output[state, symbol]:
                found[o - 1] += weight
            state = self.next_state[state, symbol]
        return found
