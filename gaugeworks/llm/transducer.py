"""Minimal acyclic transducers: sorted terms to their places in the order.

``build`` takes terms in byte order and adds one after the other: states behind the last shared prefix
are final and are replaced by an equal state met before, so that the automaton stays minimal. Each arc
carries how many terms lie before it; added up along a term they give its ordinal. Lookups walk all
given words at once, a byte at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np


@dataclass
class Transducer:
    """Arcs in order of (state, byte): ``key`` is state * 256 + byte. State 0 is the first."""

    key: np.ndarray
    target: np.ndarray
    before: np.ndarray  # terms before those that go along the arc
    final: np.ndarray  # by state
    terms: int

    @property
    def nbytes(self) -> int:
        return self.key.nbytes + self.target.nbytes + self.before.nbytes + self.final.nbytes

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 for words that are no terms."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        return self.places(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)

    def places(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ordinals of words that lie in ``data`` from ``at`` on, as many bytes as ``size`` says."""
        out = np.full(len(size), -1, np.int64)
        if not len(size) or not self.terms:
            return out
        row, state, total, left = np.arange(len(size)), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), size
        while True:
            ended = left == 0
            hit = ended & self.final[state]
            out[row[hit]] = total[hit]
            row, state, total, left, at = (x[~ended] for x in (row, state, total, left, at))
            if not len(row):
                return out
            key = state * 256 + data[at]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            on = self.key[arc] == key
            arc, row, left, at = arc[on], row[on], left[on] - 1, at[on] + 1
            state, total = self.target[arc], total[on] + self.before[arc]

    def least(self) -> bytes:
        """The first term; no bytes without terms."""
        found, state = [], 0
        while self.terms and not self.final[state]:
            arc = np.searchsorted(self.key, state * 256)
            found.append(self.key[arc] % 256)
            state = self.target[arc]
        return bytes(found)


class _State:
    __slots__ = ("arcs", "final", "count", "number")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.count, self.number = False, 0, -1


def build(terms: Iterable[bytes]) -> Transducer:
    """The minimal transducer of distinct terms in byte order."""
    known: dict[tuple, _State] = {}
    root = _State()
    path, last = [root], b""

    def close(depth: int) -> None:
        """States of the last term below ``depth`` get no more arcs: equal ones become one."""
        while len(path) > depth + 1:
            state = path.pop()
            state.count = state.final + sum(s.count for s in state.arcs.values())
            same = known.setdefault((state.final, *((b, id(s)) for b, s in state.arcs.items())), state)
            path[-1].arcs[last[len(path) - 1]] = same

    n = 0
    for term in terms:
        if n and term <= last:
            raise ValueError("terms must be distinct and in byte order")
        shared = 0
        while shared < min(len(term), len(last)) and term[shared] == last[shared]:
            shared += 1
        close(shared)
        for byte in term[shared:]:
            state = _State()
            path[-1].arcs[byte] = state
            path.append(state)
        path[-1].final = True
        last, n = term, n + 1
    close(0)
    # Numbered in order of first visit from the root.
    states, root.number = [root], 0
    for state in states:
        for s in state.arcs.values():
            if s.number < 0:
                s.number = len(states)
                states.append(s)
    key, target, before = [], [], []
    for state in states:
        passed = int(state.final)
        for byte, s in state.arcs.items():
            key.append(state.number * 256 + byte)
            target.append(s.number)
            before.append(passed)
            passed += s.count
    return Transducer(np.array(key, np.int64), np.array(target, np.int64), np.array(before, np.int64), np.array([s.final for s in states], bool), n)
