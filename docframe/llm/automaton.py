"""Regular expressions over bytes compiled to one minimal deterministic automaton.

Each rule is parsed into position-free nodes, joined into one nondeterministic automaton, determinised by
subset construction over classes of bytes that no rule tells apart, minimised by partition refinement, and
stored as transition arrays. The supported syntax: literals, escapes, classes, groups, ``|``, ``?``, ``*``,
``+``, ``{n}``, ``{n,}``, ``{n,m}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


class _Parser:
    """Recursive descent; a node is ("set", frozenset), ("cat", [..]), ("alt", [..]) or ("rep", node, low, high)."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.p, self.i, self.fold = pattern, 0, ignore_case

    def parse(self):
        node = self.alternation()
        if self.i != len(self.p):
            raise ValueError(f"unbalanced pattern at {self.i}: {self.p}")
        return node

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alternation(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        node = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.p.index("}", self.i)
                low, comma, high = self.p[self.i : end].partition(",")
                self.i = end + 1
                node = ("rep", node, int(low), int(high) if high else (None if comma else int(low)))
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            if self.p.startswith("?:", self.i):
                self.i += 2
            node = self.alternation()
            if self.take() != ")":
                raise ValueError("missing )")
            return node
        if c == "[":
            return ("set", self.char_class())
        return ("set", self.folded({self.escaped() if c == "\\" else ord(c)}))

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def char_class(self) -> frozenset:
        negate = self.peek() == "^" and bool(self.take())
        chars: set[int] = set()
        while (c := self.take()) != "]":
            low = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                c = self.take()
                chars.update(range(low, (self.escaped() if c == "\\" else ord(c)) + 1))
            else:
                chars.add(low)
        return frozenset(range(256)) - chars if negate else self.folded(chars)

    def folded(self, chars: set[int]) -> frozenset:
        if self.fold:
            text = "".join(map(chr, chars))
            chars = chars | {ord(c) for c in text.swapcase() if ord(c) < 128}
        return frozenset(chars)


@dataclass
class _Graph:
    """Nondeterministic states: empty moves and one set move each."""

    empty: list[list[int]] = field(default_factory=list)
    move: list[tuple[frozenset, int] | None] = field(default_factory=list)

    def new(self) -> int:
        self.empty.append([])
        self.move.append(None)
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Lay node down behind start; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.new()
            hook = self.new()
            self.empty[start].append(hook)
            self.move[hook] = (node[1], end)
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.new()
            for option in node[1]:
                begin = self.new()
                self.empty[start].append(begin)
                self.empty[self.add(option, begin)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        end = self.new()
        self.empty[start].append(end)
        if high is None:
            again = self.new()
            self.empty[start].append(again)
            self.empty[self.add(inner, again)].extend((again, end))
        else:
            for _ in range(high - low):
                start = self.add(inner, start)
                self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _reverse(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [_reverse(x) for x in reversed(node[1])])
    if kind == "alt":
        return ("alt", [_reverse(x) for x in node[1]])
    return ("rep", _reverse(node[1]), *node[2:]) if kind == "rep" else node


@dataclass(frozen=True)
class Automaton:
    """rows[state][byte] -> state. States from first_accepting on accept; accepts[state] are rule indices.
    dead is the state that nothing leaves, or -1."""

    rows: list[list[int]]
    start: int
    first_accepting: int
    accepts: list[tuple[int, ...]]
    dead: int

    @property
    def table(self) -> np.ndarray:
        return np.array(self.rows, np.int32)


def parse(pattern: str, ignore_case: bool = False, backwards: bool = False):
    node = _Parser(pattern, ignore_case).parse()
    return _reverse(node) if backwards else node


def build(nodes: list, anchored: bool) -> Automaton:
    """The minimal automaton of all nodes; unanchored: it may begin a match at every byte."""
    graph, ends, begins = _Graph(), {}, []
    for rule, node in enumerate(nodes):
        begin = graph.new()
        begins.append(begin)
        ends[graph.add(node, begin)] = rule
    sets = sorted({m[0] for m in graph.move if m}, key=sorted)
    kinds: dict[tuple, list[int]] = {}
    for byte in range(256):
        kinds.setdefault(tuple(byte in s for s in sets), []).append(byte)
    classes = list(kinds.values())
    first = graph.closure(begins)
    known, order, moves = {first: 0}, [first], []
    for current in order:
        out = []
        for members in classes:
            reached = [m[1] for s in current if (m := graph.move[s]) and members[0] in m[0]]
            nxt = graph.closure(reached + ([] if anchored else begins))
            if nxt not in known:
                known[nxt] = len(order)
                order.append(nxt)
            out.append(known[nxt])
        moves.append(out)
    accepts = [tuple(sorted(ends[s] for s in states if s in ends)) for states in order]
    table, block = np.array(moves), np.unique([str(a) for a in accepts], return_inverse=True)[1].reshape(-1)
    while True:  # Moore's refinement: states are one while all their moves lead to the same blocks
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    member = {int(b): i for i, b in enumerate(block)}
    ranked = sorted(member, key=lambda b: (bool(accepts[member[b]]), b))
    place = {b: i for i, b in enumerate(ranked)}
    rows = []
    for b in ranked:
        row = [0] * 256
        for k, members in enumerate(classes):
            target = place[int(block[table[member[b], k]])]
            for byte in members:
                row[byte] = target
        rows.append(row)
    final = [accepts[member[b]] for b in ranked]
    dead = next((i for i, r in enumerate(rows) if not final[i] and set(r) == {i}), -1)
    return Automaton(rows, place[int(block[0])], sum(not a for a in final), final, dead)
