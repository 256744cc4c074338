"""Byte automata for operator 11: patterns to tables.

A pattern is parsed to a small tree, the tree becomes a non-deterministic
automaton, subset construction makes that deterministic, and merging states that
no text can tell apart (partition refinement) makes it minimal.  The result is a
transition array over classes of bytes.

Patterns know literals, ``\\xHH`` and escaped characters, classes with ranges,
groups, ``(?i:...)`` for ASCII letters in either case, ``|``, ``?``, ``*``, ``+`` and
``{n}``, ``{n,}``, ``{n,m}``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_ATOM = re.compile(rb"\\x([0-9A-Fa-f]{2})|\\(.)|([^\\])", re.S)
_COUNT = re.compile(rb"\{(\d+)(,?)(\d*)\}")


class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at = pattern.encode("ascii"), 0

    def peek(self) -> bytes:
        return self.text[self.at : self.at + 1]

    def byte(self) -> int:
        m = _ATOM.match(self.text, self.at)
        self.at = m.end()
        return int(m[1], 16) if m[1] else (m[2] or m[3])[0]

    def either(self, fold: bool):
        options = [self.sequence(fold)]
        while self.peek() == b"|":
            self.at += 1
            options.append(self.sequence(fold))
        return ("or", options)

    def sequence(self, fold: bool):
        parts = []
        while self.peek() not in (b"", b"|", b")"):
            parts.append(self.repeated(self.atom(fold)))
        return ("then", parts)

    def atom(self, fold: bool):
        if self.peek() == b"(":
            self.at += 1
            if self.text.startswith(b"?i:", self.at):
                self.at, fold = self.at + 3, True
            inner = self.either(fold)
            self.at += 1
            return inner
        if self.peek() == b"[":
            self.at += 1
            found: set[int] = set()
            while self.peek() != b"]":
                low = high = self.byte()
                if self.peek() == b"-" and self.text[self.at + 1 : self.at + 2] != b"]":
                    self.at += 1
                    high = self.byte()
                found.update(range(low, high + 1))
            self.at += 1
        else:
            found = {self.byte()}
        if fold:
            found |= {ord(chr(b).swapcase()) for b in found if b < 128}
        return ("byte", frozenset(found))

    def repeated(self, node):
        sign = self.peek()
        bounds = {b"?": (0, 1), b"*": (0, None), b"+": (1, None)}.get(sign)
        if bounds:
            self.at += 1
        elif m := _COUNT.match(self.text, self.at):
            self.at = m.end()
            bounds = int(m[1]), (int(m[3]) if m[3] else None) if m[2] else int(m[1])
        return ("repeat", node, *bounds) if bounds else node


class _Nfa:
    """States are numbers; ``steps[s]`` holds (bytes, next), ``free[s]`` the next states without a byte."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, begin: int, backwards: bool) -> int:
        """Hangs ``node`` on state ``begin``; returns the state at its end."""
        kind = node[0]
        if kind == "byte":
            end = self.state()
            self.steps[begin].append((node[1], end))
        elif kind == "then":
            end = begin
            for part in reversed(node[1]) if backwards else node[1]:
                end = self.add(part, end, backwards)
        elif kind == "or":
            end = self.state()
            for option in node[1]:
                self.free[self.add(option, self.branch(begin), backwards)].append(end)
        else:
            _, inner, least, most = node
            end = begin
            for _ in range(least):
                end = self.add(inner, end, backwards)
            if most is None:
                loop = self.branch(end)
                self.free[self.add(inner, loop, backwards)].append(loop)
                end = loop
            else:
                out = self.branch(end)
                for _ in range(most - least):
                    end = self.add(inner, end, backwards)
                    self.free[end].append(out)
                end = out
        return end

    def branch(self, begin: int) -> int:
        new = self.state()
        self.free[begin].append(new)
        return new

    def reach(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    """``step[s * width + classes[byte]]`` is the next state times ``width``; the start
    state is 0; ``accepts`` has a bit per pattern for each state, and states
    that accept something come last (from ``first_accepting`` on)."""

    classes: np.ndarray
    width: int
    step: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    dead: int


def compile_patterns(patterns: list[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """The minimal automaton of all ``patterns`` together.

    ``backwards`` reads a text from its end; with ``anywhere`` a match may begin
    at any byte, so a state tells of all matches that end there.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for i, pattern in enumerate(patterns):
        ends[nfa.add(_Parser(pattern).either(False), nfa.branch(start), backwards)] = i
    # bytes that no pattern tells apart are one class
    sets = sorted({b for steps in nfa.steps for b, _ in steps}, key=sorted)
    kinds = np.array([[byte in s for s in sets] for byte in range(256)])
    _, sample, classes = np.unique(kinds, axis=0, return_index=True, return_inverse=True)
    width = len(sample)

    first = nfa.reach([start])
    number, todo, rows = {first: 0}, [first], []
    for subset in todo:
        row = []
        for byte in sample.tolist():
            moved = {to for s in subset for allowed, to in nfa.steps[s] if byte in allowed}
            target = nfa.reach(moved) | (first if anywhere else frozenset())
            if target not in number:
                number[target] = len(todo)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    accepts = np.array([sum(1 << ends[s] for s in subset if s in ends) for subset in todo], np.int64)
    return _minimal(np.array(rows), accepts, classes.astype(np.uint8).ravel(), width)


def _minimal(rows: np.ndarray, accepts: np.ndarray, classes: np.ndarray, width: int) -> Automaton:
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    of = np.unique(block, return_index=True)[1]  # a state of each block
    order = np.lexsort((np.arange(len(of)) != block[0], accepts[of] != 0))
    if accepts[0]:
        raise ValueError("a pattern must not match the empty text")
    place = np.empty(len(of), np.int64)
    place[order] = np.arange(len(of))
    step = place[block[rows[of[order]]]]
    loops = (step == np.arange(len(of))[:, None]).all(1) & (accepts[of[order]] == 0)
    dead = int(np.flatnonzero(loops)[0]) if loops.any() else -1
    found = accepts[of[order]]
    return Automaton(
        classes, width, (step * width).astype(np.int32).ravel(), found,
        int((found == 0).sum()) * width, dead * width if dead >= 0 else -1,
    )
