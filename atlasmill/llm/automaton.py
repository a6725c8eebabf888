"""A deterministic automaton over bytes for several regular expressions at once.

The expressions know literals, classes, groups, |, ?, *, + and {m,n}. They become one NFA; subset construction gives the
transition array and minimisation by partition refinement merges equal states. unanchored: a match may begin at any byte.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ESCAPES = {"n": 10, "t": 9, "r": 13}


class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.on: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.eps.append([])
        self.on.append([])
        return len(self.eps) - 1


class _Parser:
    """Recursive descent; each method returns a function that adds the part to an NFA and gives its first and last state."""

    def __init__(self, text: str, either_case: bool):
        self.s, self.i, self.either = text, 0, either_case

    def more(self) -> str:
        return self.s[self.i] if self.i < len(self.s) else ""

    def byte(self) -> int:
        c = self.s[self.i]
        self.i += 1
        if c != "\\":
            return ord(c)
        c = self.s[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        return _ESCAPES.get(c, ord(c))

    def cases(self, chars: set[int]) -> frozenset[int]:
        if self.either:
            chars = chars | {ord(chr(b).swapcase()) for b in chars if b < 128 and chr(b).isalpha()}
        return frozenset(chars)

    def choice(self):
        parts = [self.sequence()]
        while self.more() == "|":
            self.i += 1
            parts.append(self.sequence())

        def build(nfa: _Nfa):
            a, b = nfa.state(), nfa.state()
            for p in parts:
                x, y = p(nfa)
                nfa.eps[a].append(x)
                nfa.eps[y].append(b)
            return a, b

        return build

    def sequence(self):
        parts = []
        while self.more() not in ("", "|", ")"):
            parts.append(self.repeated())

        def build(nfa: _Nfa):
            a = b = nfa.state()
            for p in parts:
                x, y = p(nfa)
                nfa.eps[b].append(x)
                b = y
            return a, b

        return build

    def repeated(self):
        part, lo, hi = self.atom(), 1, 1
        match self.more():
            case "?":
                lo, hi = 0, 1
            case "*":
                lo, hi = 0, None
            case "+":
                lo, hi = 1, None
            case "{":
                end = self.s.index("}", self.i)
                a, comma, b = self.s[self.i + 1 : end].partition(",")
                lo, hi = int(a), int(b) if b else None if comma else int(a)
                self.i = end
            case _:
                self.i -= 1
        self.i += 1

        def build(nfa: _Nfa):
            a = b = nfa.state()
            for _ in range(lo):
                x, y = part(nfa)
                nfa.eps[b].append(x)
                b = y
            if hi is None:
                x, y = part(nfa)
                c = nfa.state()
                nfa.eps[b] += [x, c]
                nfa.eps[y] += [x, c]
                return a, c
            end = nfa.state()
            for _ in range(hi - lo):
                nfa.eps[b].append(end)
                x, y = part(nfa)
                nfa.eps[b].append(x)
                b = y
            nfa.eps[b].append(end)
            return a, end

        return build

    def atom(self):
        if self.more() == "(":
            self.i += 1
            part = self.choice()
            self.i += 1
            return part
        if self.more() == "[":
            self.i += 1
            no = self.more() == "^"
            self.i += no
            chars: set[int] = set()
            while self.more() != "]":
                a = self.byte()
                if self.more() == "-" and self.s[self.i + 1] != "]":
                    self.i += 1
                    chars |= set(range(a, self.byte() + 1))
                else:
                    chars.add(a)
            self.i += 1
            on = self.cases(chars)
            on = frozenset(range(256)) - on if no else on
        else:
            on = self.cases({self.byte()})

        def build(nfa: _Nfa):
            a, b = nfa.state(), nfa.state()
            nfa.on[a].append((on, b))
            return a, b

        return build


@dataclass
class Automaton:
    """next[state, byte]; state 0 is the first. accepts[state]: a bit for each expression that ends there. dead: no match to come."""

    next: np.ndarray
    accepts: np.ndarray
    dead: np.ndarray

    def rests(self) -> np.ndarray:
        """[a, b]: after bytes a and b the automaton is in its first state, whatever its state before."""
        two = self.next[self.next]  # state, a, b
        return (two == 0).all(axis=0)


def compile_all(expressions: list[tuple[str, bool]], unanchored: bool, backwards: bool = False) -> Automaton:
    """(expression, either case) each. backwards: for one expression, over bytes from right to left."""
    nfa = _Nfa()
    first = nfa.state()
    ends: dict[int, int] = {}
    for k, (text, either) in enumerate(expressions):
        a, b = _Parser(text, either).choice()(nfa)
        nfa.eps[first].append(a)
        ends[b] = 1 << k
    if backwards:
        turned = _Nfa()
        for _ in nfa.eps:
            turned.state()
        for s in range(len(nfa.eps)):
            for t in nfa.eps[s]:
                turned.eps[t].append(s)
            for on, t in nfa.on[s]:
                turned.on[t].append((on, s))
        (last,) = ends
        nfa, first, ends = turned, last, {first: 1}
    closures: list[frozenset[int]] = []
    for s in range(len(nfa.eps)):
        seen, todo = {s}, [s]
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        closures.append(frozenset(t for t in seen if nfa.on[t] or t in ends))
    # bytes that no class tells apart are one letter of the alphabet
    sets = sorted({on for arcs in nfa.on for on, _ in arcs}, key=sorted)
    mark = np.array([[b in on for on in sets] for b in range(256)])
    _, sample, letter = np.unique(mark, axis=0, return_index=True, return_inverse=True)
    base = closures[first] if unanchored else frozenset()
    number, todo, table = {closures[first]: 0}, [closures[first]], []
    for now in todo:
        row = []
        for b in sample.tolist():
            to = base.union(*(closures[t] for s in now for on, t in nfa.on[s] if b in on))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    step = np.array(table)
    accepts = np.array([sum({ends[s] for s in now if s in ends}) for now in todo])
    block = np.unique(accepts, return_inverse=True)[1]
    while True:  # states stay together while their accepts and the blocks they lead to agree
        _, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer
    order = np.concatenate(([block[0]], np.setdiff1d(np.arange(block.max() + 1), block[0])))
    name = np.empty_like(order)
    name[order] = np.arange(len(order))
    some = np.array([int(np.argmax(block == b)) for b in order])
    out = name[block[step[some]]][:, letter.ravel()].astype(np.int32)
    acc = accepts[some]
    live = acc > 0
    while (grown := live | live[out].any(axis=1)).sum() > live.sum():
        live = grown
    return Automaton(out, acc, ~live)
