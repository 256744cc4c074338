"""Operator 9: token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes.  A node's failure link leads to where the
match goes on once greedy longest match has emitted the pieces it must emit
there, and ``popped`` holds how many pieces that is, worked out beforehand.
One walk over a word's bytes thus gives its number of pieces, in linear time
and without building a piece.

A word is a run without white space (blank, tab to carriage return), taken with
one blank before it, as the vocabulary marks the start of words.  A byte that
the vocabulary lacks counts as one piece.  The vocabulary file is read on the
driver and broadcast; a worker remembers counts of a bounded number of words.

Defined results: null and empty texts have 0 words and 0 tokens; very long words
take linear time; repeated rows give repeated results; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from placeseek.llm.bpe import MEMO_WORDS, ROWS_AT_ONCE, byte_characters, share
from placeseek.llm.common import map_arrow, slices
from placeseek.llm.fingerprints import words_of


def vocabulary(spec: str) -> set[bytes]:
    """The pieces of a byte-level tokenizer file, added tokens left out."""
    spec = json.loads(spec)
    to_byte, added = byte_characters(), {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(map(to_byte.__getitem__, t)) for t in spec["model"]["vocab"] if t not in added}


class LongestMatch:
    """The automaton of a set of pieces."""

    def __init__(self, pieces: set[bytes]):
        self.next: dict[int, int] = {}  # node * 256 + byte -> node
        parent, last, is_piece = [0], [0], [False]
        for piece in sorted(pieces | {bytes([b]) for b in range(256)}):
            node = 0
            for b in piece:
                at = node << 8 | b
                if at not in self.next:
                    self.next[at] = len(parent)
                    parent.append(node)
                    last.append(b)
                    is_piece.append(False)
                node = self.next[at]
            is_piece[node] = True
        self.fail, self.popped = [0] * len(parent), [0] * len(parent)
        children: list[list[int]] = [[] for _ in parent]
        for node in range(1, len(parent)):
            children[parent[node]].append(node)
        queue = deque(children[0])
        while queue:  # shorter nodes first
            node = queue.popleft()
            queue.extend(children[node])
            if is_piece[node]:
                self.popped[node] = 1  # the node itself; the match starts anew
                continue
            up, b = parent[node], last[node]
            to, n = self.fail[up], self.popped[up]
            while (goes := self.next.get(to << 8 | b)) is None:
                n += self.popped[to]
                to = self.fail[to]
            self.fail[node], self.popped[node] = goes, n

    def count(self, word: bytes) -> int:
        node = n = 0
        go, fail, popped = self.next, self.fail, self.popped
        for b in word:
            while (to := go.get(node << 8 | b)) is None:
                n += popped[node]
                node = fail[node]
            node = to
        while node:
            n += popped[node]
            node = fail[node]
        return n


_BUILT: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def _built(spec: Broadcast) -> tuple[LongestMatch, dict[bytes, int]]:
    key = hashlib.md5(spec.value.encode()).hexdigest()
    if key not in _BUILT:
        _BUILT[key] = LongestMatch(vocabulary(spec.value)), {}
    return _BUILT[key]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words`` and ``n_tokens``."""
    spec = share(docs.sparkSession, tokenizer)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, memo = _built(spec)
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                words, tokens = [], []
                for text in part.column(1).to_pylist():
                    found = words_of(text)
                    for w in set(found).difference(memo):
                        memo[w] = automaton.count(b" " + w)
                    words.append(len(found))
                    tokens.append(sum(map(memo.__getitem__, found)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    names=[id_col, "n_words", "n_tokens"],
                )

    return map_arrow(docs.select(id_col, text_col), step, f"`{id_col}` {id_type}, n_words long, n_tokens long")
