"""All rules as one deterministic automaton: subset construction per rule, their product, minimisation, and a numpy byte scan.

Semantics of every rule are those of a leftmost, greedy, non-overlapping search.
A rule whose search would have to look past the end of its match and come back
is refused by `compile_rules`; so are rules that match fewer than two bytes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from re import _parser as sre

import numpy as np

#: Bytes of a text that one lane of the scan takes.
LANE = 1024
_MATCH = -1


@dataclass(frozen=True)
class Rule:
    """kind: its name; pattern: over ASCII; either_case: letters match in both cases; group, least: matches whose group is shorter are dropped."""

    kind: str
    pattern: str
    either_case: bool = False
    group: int = 0
    least: int = 0


@dataclass
class _Nfa:
    sets: list[np.ndarray | None] = field(default_factory=list)  # bytes a state consumes; None: an empty step
    to: list[list[int]] = field(default_factory=list)  # targets, best first

    def add(self, chars: np.ndarray | None, to: list[int]) -> int:
        self.sets.append(chars)
        self.to.append(to)
        return len(self.sets) - 1

    def closure(self, states: Sequence[int]) -> tuple[int, ...]:
        """Consuming states reached without input, best first; what comes after a match is cut."""
        out: list[int] = []
        seen: set[int] = set()
        stack = list(reversed(states))
        while stack:
            s = stack.pop()
            if s in seen:
                continue
            seen.add(s)
            if s == _MATCH:
                out.append(s)
                break
            if self.sets[s] is None:
                stack += reversed(self.to[s])
            else:
                out.append(s)
        return tuple(out)

    def all_closure(self, states: Sequence[int]) -> frozenset[int]:
        seen: set[int] = set()
        stack = list(states)
        while stack:
            s = stack.pop()
            if s not in seen:
                seen.add(s)
                if s != _MATCH and self.sets[s] is None:
                    stack += self.to[s]
        return frozenset(s for s in seen if s == _MATCH or self.sets[s] is not None)


def _chars(items: list, either_case: bool) -> np.ndarray:
    mask = np.zeros(256, bool)
    negate = False
    for op, arg in items:
        if op == sre.NEGATE:
            negate = True
        elif op == sre.LITERAL:
            mask[arg] = True
        elif op == sre.RANGE:
            mask[arg[0] : arg[1] + 1] = True
        else:
            raise ValueError(f"{op} is not supported in a character class")
    if either_case:
        mask[65:91] = mask[97:123] = mask[65:91] | mask[97:123]
    return ~mask if negate else mask


def _build(nfa: _Nfa, tree, after: int, either_case: bool, backwards: bool) -> int:
    """First state of the part of the automaton that matches tree and goes on with state after."""
    for op, arg in tree if backwards else reversed(list(tree)):
        if op in (sre.LITERAL, sre.RANGE, sre.NOT_LITERAL):
            items = [(sre.NEGATE, None), (sre.LITERAL, arg)] if op == sre.NOT_LITERAL else [(op, arg)]
            after = nfa.add(_chars(items, either_case), [after])
        elif op == sre.IN:
            after = nfa.add(_chars(arg, either_case), [after])
        elif op == sre.SUBPATTERN:
            after = _build(nfa, arg[3], after, either_case, backwards)
        elif op == sre.BRANCH:
            after = nfa.add(None, [_build(nfa, b, after, either_case, backwards) for b in arg[1]])
        elif op == sre.MAX_REPEAT:
            least, most, part = arg
            if most == sre.MAXREPEAT:
                loop = nfa.add(None, [])
                nfa.to[loop] = [_build(nfa, part, loop, either_case, backwards), after]
                after = loop
            else:
                for _ in range(most - least):
                    after = nfa.add(None, [_build(nfa, part, after, either_case, backwards), after])
            for _ in range(least):
                after = _build(nfa, part, after, either_case, backwards)
        else:
            raise ValueError(f"{op} is not supported in a rule")
    return after


class _Search:
    """Leftmost-first search automaton of one rule, determinised as it is asked for."""

    def __init__(self, rule: Rule):
        self.rule, self.nfa = rule, _Nfa()
        tree = sre.parse(rule.pattern)
        if tree.getwidth()[0] < 2:
            raise ValueError(f"{rule.kind}: a rule must match two bytes at least")
        self.begin = self.nfa.closure([_build(self.nfa, tree, _MATCH, rule.either_case, False)])

    def step(self, state: tuple[int, ...], byte: int) -> tuple[int, ...]:
        reached = [t for s in state if s != _MATCH and self.nfa.sets[s][byte] for t in self.nfa.to[s]]
        new = self.nfa.closure(reached)
        if _MATCH in new:
            return new
        if _MATCH in state:  # a match has been found, and nothing new is begun before it is over
            if new:
                raise ValueError(f"{self.rule.kind}: the search would have to look past a match and come back")
            return self.step(self.begin, byte)
        return tuple(dict.fromkeys(new + self.begin))


class _Backwards:
    """Reads a match from its end; used to find the start."""

    def __init__(self, rule: Rule):
        self.nfa = _Nfa()
        start = _build(self.nfa, sre.parse(rule.pattern), _MATCH, rule.either_case, True)
        self.begin, self.memo = self.nfa.all_closure([start]), {}

    def leftmost(self, data: bytes, end: int, bound: int) -> int:
        state, best = self.begin, -1
        for at in range(end - 1, bound - 1, -1):
            key = (state, data[at])
            if key not in self.memo:
                self.memo[key] = self.nfa.all_closure([t for s in state if s != _MATCH and self.nfa.sets[s][data[at]] for t in self.nfa.to[s]])
            state = self.memo[key]
            if not state:
                break
            if _MATCH in state:
                best = at
        return best


class Automaton:
    """table: next state by state and byte class; accept: bit k of a state is set while rule k has a match that ends there."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        searches = [_Search(r) for r in rules]
        columns = np.array([s for x in searches for s in x.nfa.sets if s is not None])
        _, first, classes = np.unique(columns, axis=1, return_index=True, return_inverse=True)
        self.classes = classes.reshape(-1).astype(np.int32)
        start = tuple(x.begin for x in searches)
        ids, queue, rows = {start: 0}, [start], []
        memo: list[dict] = [{} for _ in searches]
        while queue:
            state, row = queue.pop(), []
            for byte in first:
                new = []
                for x, m, s in zip(searches, memo, state, strict=True):
                    key = (s, byte)
                    if key not in m:
                        m[key] = x.step(s, byte)
                    new.append(m[key])
                new = tuple(new)
                if new not in ids:
                    ids[new] = len(ids)
                    queue.append(new)
                row.append(ids[new])
            rows.append((ids[state], row))
        table = np.array([r for _, r in sorted(rows)], np.int64)
        accept = np.array([sum(1 << k for k, s in enumerate(state) if _MATCH in s) for state in ids], np.int64)
        self.states_before = len(table)
        block = np.unique(accept, return_inverse=True)[1]
        while True:  # split blocks until all states of a block go to the same blocks
            _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
            finer = finer.reshape(-1)
            if finer.max() == block.max():
                break
            block = finer
        member = np.unique(block, return_index=True)[1]
        self.table = block[table[member]].astype(np.int32)
        self.accept = accept[member].astype(np.uint32)
        self.start = int(block[0])
        width = self.table.shape[1]
        self._flat = (self.table * width).ravel()  # states are kept times the width
        self._accept = np.zeros(len(self.table) * width, np.uint32)
        self._accept[::width] = self.accept
        self.backwards = [_Backwards(r) for r in rules]
        self.exact = [re.compile(r.pattern.encode(), re.IGNORECASE if r.either_case else 0) for r in rules]

    def _run(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All lanes side by side, a byte of each at a time: their last states; lane, position and rule bits of each match that ended inside."""
        order = np.argsort(-length, kind="stable")
        longest = int(length[order[0]])
        alive = np.searchsorted(-length[order], -np.arange(1, longest + 1), "right")
        at = begin[order]
        state = state[order]
        final = np.empty_like(state)
        held = self._accept[state]
        lanes, places, bits = [], [], []
        for t, k in enumerate(alive.tolist()):
            if k < len(state):  # lanes that are over
                final[order[k : len(state)]] = state[k:]
                state, held, at = state[:k], held[:k], at[:k]
            state = self._flat[state + self.classes[data[at + t]]]
            now = self._accept[state]
            gone = held & ~now
            if gone.any():
                where = np.flatnonzero(gone)
                lanes.append(order[where])
                places.append(at[where] + t)
                bits.append(gone[where])
            held = now
        final[order[: len(state)]] = state
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return final, join(lanes, np.int64), join(places, np.int64), join(bits, np.uint32)

    def ends(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rule bits) of every end of a match, exclusive. A position at a row's end belongs to that row.

        Rows are cut into lanes that all run from the start state at once; a lane
        whose forerunner ended in another state runs again from that state.
        """
        bounds = np.unique(np.concatenate([offsets, np.arange(0, len(data), LANE)]))
        begin, length = bounds[:-1], np.diff(bounds)
        if not len(begin):
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        opens = np.isin(begin, offsets)
        closes = np.append(opens[1:], True)
        home = self.start * self.table.shape[1]
        first = np.full(len(begin), home, np.int32)
        final = first.copy()
        lanes, places, bits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        todo = np.arange(len(begin))
        while len(todo):
            final[todo], lane, place, bit = self._run(data, begin[todo], length[todo], first[todo])
            old = ~np.isin(lanes, todo)
            lanes, places, bits = np.append(lanes[old], todo[lane]), np.append(places[old], place), np.append(bits[old], bit)
            wanted = np.where(opens, home, np.append(home, final[:-1]).astype(np.int32))
            todo = np.flatnonzero(wanted != first)
            first = wanted
        open_end = self._accept[final] * closes
        more = np.flatnonzero(open_end)
        places, bits = np.append(places, bounds[more + 1]), np.append(bits, open_end[more].astype(np.uint32))
        order = np.argsort(places, kind="stable")
        return places[order], bits[order]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, start, end, rule) in code points of the row, by row, start and rule; matches whose group is too short are dropped."""
        where, bits = self.ends(data, offsets)
        rows = np.searchsorted(offsets, where, "left") - 1  # an end at a row's end belongs to the row before it
        out = []
        for row in np.unique(rows).tolist():
            low = int(offsets[row])
            body = data[low : offsets[row + 1]]
            text = body.tobytes()
            points = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
            mine, floor = rows == row, [0] * len(self.rules)
            found = []
            for end, bit in zip((where[mine] - low).tolist(), bits[mine].tolist(), strict=True):
                for k, rule in enumerate(self.rules):
                    if bit >> k & 1:
                        start = self.backwards[k].leftmost(text, end, floor[k])
                        floor[k] = end
                        if rule.least:
                            hit = self.exact[k].fullmatch(text, start, end)
                            if len(hit.group(rule.group)) < rule.least:
                                continue
                        found.append((row, int(points[start]), int(points[end]), k))
            out += sorted(found, key=lambda x: (x[1], x[3]))
        return out
