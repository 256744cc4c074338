"""Operator 11: secret scans with one combined deterministic automaton.

A rule is a head (a pattern), a tail (a class of characters that follows it one
or more times) and the least number of tail characters of a match that counts.  All
rules are compiled to one minimal automaton (see ``automata``) that reads a text backwards,
a byte a step: its state at a byte tells of every rule that has a match starting
there.  So one pass over the bytes marks the starts of all rules.  Per rule the matches are
then the first start, its longest match, the first start after that, and so on;
the lengths come from the rule's own forward automaton, which only reads bytes of matches.
Matches with too short a tail are dropped afterwards, as they still use up their text.

The pass runs over all texts of a slice at once (joined by a byte that no text
holds), cut into lanes of equal length that take each step together.  A lane begins in the
start state, as if the lane before it had ended there; lanes for which that turns out
wrong are read again from the true state until they meet the states they had before.

Defined results: a null or empty text has no spans; a text may be of any length and
hold any characters (positions count code points); null ids and repeated rows are
rows like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from placeseek.llm.automata import Automaton, compile_patterns
from placeseek.llm.common import map_arrow, slices

#: Bytes of a lane, and texts of a slice.
LANE = 512
ROWS_AT_ONCE = 512
#: Bytes scanned together, give or take the last text.
BYTES_AT_ONCE = 1 << 21
# Fixed value: a byte that UTF-8 never holds and no rule reads.
_BETWEEN = b"\xff"


@dataclass(frozen=True)
class Rule:
    """``head`` followed by one or more of ``tail``, ``least`` of them to count.  Without a
    head the match is a whole run of ``tail``; without a tail it is the head alone."""

    kind: str
    head: str
    tail: str = ""
    least: int = 1

    @property
    def pattern(self) -> str:
        return f"{self.head}{self.tail}+" if self.tail else self.head

    @property
    def marked(self) -> str:
        """What a start is marked by: a run without a head only counts if it is long
        enough, and the first such start of a run is its beginning."""
        return self.pattern if self.head else f"{self.tail}{{{self.least},}}"


# The rules of the contract, in its order.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
)
# Well-known forms of other secrets, scanned in the same pass.
MORE_RULES = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.", "[A-Za-z0-9_-]", 10),
    Rule("hosting", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        self.starts = compile_patterns([r.marked for r in rules], backwards=True, anywhere=True)
        self.whole = [compile_patterns([r.pattern]) for r in rules]
        self.heads = [compile_patterns([r.head]) if r.head and r.tail else None for r in rules]

    def marks(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a rule's match starts, ascending, and the bits of those rules."""
        a, n = self.starts, len(raw)
        lanes = -(-n // LANE)
        read = np.zeros(lanes * LANE, np.uint8)
        read[:n] = a.classes[np.frombuffer(raw, np.uint8)[::-1]]
        read = np.ascontiguousarray(read.reshape(lanes, LANE).T)
        states = np.empty((LANE, lanes), np.int32)
        s = np.zeros(lanes, np.int32)
        for i in range(LANE):
            s = a.step[s + read[i]]
            states[i] = s
        again = np.flatnonzero(s[:-1]) + 1  # the lane before did not end in the start state
        while len(again):
            s = states[-1, again - 1]
            for i in range(LANE):
                s = a.step[s + read[i, again]]
                new = s != states[i, again]
                if not new.all():
                    again, s = again[new], s[new]
                    if not len(again):
                        break
                states[i, again] = s
            again = again[again < lanes - 1] + 1
        i, lane = np.nonzero(states >= a.first_accepting)
        at = n - 1 - (lane * LANE + i)
        bits = a.accepts[states[i, lane] // a.width]
        order = np.argsort(at)
        order = order[at[order] >= 0]
        return at[order], bits[order]

    def spans(self, texts: list[bytes | None]) -> list[list[tuple[str, int, int]]]:
        """Per text its spans (kind, start, end) in code points, by start and then rule."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        raws = [t or b"" for t in texts]
        at, bits = self.marks(_BETWEEN.join(raws))
        if not len(at):
            return out
        ends = np.cumsum([len(r) + 1 for r in raws])
        doc = np.searchsorted(ends, at, side="right")
        edges = np.flatnonzero(np.diff(doc, prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)]):
            d = int(doc[a])
            raw = raws[d]
            local = at[a:b] - (int(ends[d]) - len(raw) - 1)
            found = []
            for r in range(len(self.rules)):
                starts = local[(bits[a:b] >> r) & 1 == 1].tolist()
                found += [(start, r, end) for start, end in self._matches(raw, starts, r)]
            found.sort()
            out[d] = [(self.rules[r].kind, s, e) for (s, e), r in zip(_code_points(raw, [(s, e) for s, _, e in found]), [f[1] for f in found])]
        return out

    def _matches(self, raw: bytes, starts: list[int], r: int) -> Iterator[tuple[int, int]]:
        rule, i, free = self.rules[r], 0, 0
        while (i := bisect_left(starts, free, i)) < len(starts):
            start = starts[i]
            free = _longest(self.whole[r], raw, start)
            head = _longest(self.heads[r], raw, start) if self.heads[r] else start
            if not rule.tail or free - head >= rule.least:
                yield start, free


def _longest(a: Automaton, raw: bytes, start: int) -> int:
    """End of the longest match of ``a`` from ``start`` on."""
    s, end, step, classes = 0, start, a.step, a.classes
    for i in range(start, len(raw)):
        s = int(step[s + int(classes[raw[i]])])
        if s >= a.first_accepting:
            end = i + 1
        elif s == a.dead:
            break
    return end


def _code_points(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if raw.isascii() or not spans:
        return spans
    inner = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80)
    at = np.array(spans)
    return [tuple(x) for x in (at - np.searchsorted(inner, at)).tolist()]


def _portions(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """``texts`` in groups of some ``BYTES_AT_ONCE``."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or b"")
        if size >= BYTES_AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(
    docs: DataFrame, rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end) by
    start, then in the order of ``rules``; ends are exclusive."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(rules))  # a few tables per rule
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                spans = []
                for group in _portions(part.column(1).cast(pa.binary()).to_pylist()):
                    spans += [[dict(zip(("kind", "start", "end"), x)) for x in per] for per in scanner.value.spans(group)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, pa.list_(_SPAN))], names=[id_col, "spans"])

    return map_arrow(
        docs.select(id_col, text_col), step, f"`{id_col}` {id_type}, spans array<struct<kind: string, start: long, end: long>>"
    )
