"""Operator 5: byte-level BPE by speculate and verify, and its decoding.

For every word not met before, greedy longest match over the vocabulary
proposes tokens.  A sequence of tokens is the BPE encoding exactly if each
adjacent pair is *compatible*: merging the bytes of the pair by the merge list
gives that pair back (the first merge that crosses a boundary would also be
the first to cross it in the pair alone).  All adjacent pairs of a batch are
tested at once against a sorted table of judged pairs; a pair not judged yet is
judged by merging its bytes.  Only words with an incompatible pair are merged
exactly.  Words are the pre-tokens of the byte-level pattern.

The tokenizer file is read once on the driver and broadcast (a file of fixed
size); each Python worker builds its tables once.  Memos of words have a size
bound: words not met for a while are forgotten, which costs time and changes no result.

Defined results: a null text counts as empty and has no ids; strings of added
tokens inside a text become those tokens, as the library does by default; any
white space, very long words, repeated rows and empty tables are handled;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from placeseek.llm.common import map_arrow, slices

# Unicode white space, and the pre-token pattern of byte-level BPE.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Fixed value: the same pattern where white space has Unicode's meaning by itself.
_RANKED_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: letters below this are letters in every version of Unicode in use.
_NOT_PLAIN = "\u0250"
#: Most words a worker remembers, and rows it encodes at a time.
MEMO_WORDS = 600_000
ROWS_AT_ONCE = 128
_HEAP_FROM = 400
_NO_RANK = 1 << 60


def byte_characters() -> dict[str, int]:
    """Byte-level BPE's printable stand-in for each byte: printable Latin-1
    bytes stand for themselves, the others follow from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memo[V]:
    """What was worked out for words met lately, in ``now``.  Once it holds ``size`` words they are set
    aside; those met again come back, the others are gone with the next ``size``."""

    def __init__(self, size: int):
        self.size = size
        self.now: dict[str, V] = {}
        self.older: dict[str, V] = {}

    def turn_over(self) -> None:
        if len(self.now) > self.size:
            self.older, self.now = self.now, {}

    def unknown(self, words: set[str]) -> set[str]:
        """Those of ``words`` that have to be worked out."""
        new = words.difference(self.now)  # a plain dict: looked up, not walked through
        if new and self.older:
            again = [w for w in new if w in self.older]
            self.now.update([(w, self.older[w]) for w in again])
            new.difference_update(again)
        return new


class Bpe:
    """Tables of one tokenizer file, and the words met so far."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.width = max([*vocab.values(), *self.added.values()]) + 1
        self._build_tables(vocab, spec["model"]["merges"])
        self.find = regex.compile(_PRETOKEN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None
        self.pieces: _Memo[bytes] = _Memo(MEMO_WORDS // 6)
        self.chunks: _Memo[bytes | None] = _Memo(MEMO_WORDS // 2)
        self.pairs = np.empty(0, np.int64)  # judged pairs, sorted
        self.fits = np.empty(0, bool)
        self.exact_words = self.all_words = 0

    def _build_tables(self, vocab: dict[str, int], merges: list) -> None:
        """The bytes of the tokens, for the proposals, and the merge list."""
        to_byte = byte_characters()
        n = self.width
        self.bytes_of = [b""] * n
        self.id_of: dict[bytes, int] = {}
        for token, i in vocab.items():
            raw = bytes(map(to_byte.__getitem__, token))
            self.bytes_of[i] = raw
            if token not in self.added:
                self.id_of[raw] = i
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.reach: dict[bytes, int] = {}  # longest token by its first three bytes
        for raw in self.id_of:
            self.reach[raw[:3]] = max(len(raw), self.reach.get(raw[:3], 0))
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a] * n + vocab[b]] = r
            self.merged.append(vocab[a + b])

    # ------------------------------------------------------------- one word

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE: the lowest-ranked adjacent pair, leftmost first, until none is left."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) >= _HEAP_FROM:
            return self._merge_long(ids)
        n, rank, merged = self.width, self.rank, self.merged
        ranks = [rank.get(a * n + b, _NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == _NO_RANK:
                break
            i = ranks.index(least)
            ids[i : i + 2] = [merged[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] * n + ids[i], _NO_RANK)
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] * n + ids[i + 1], _NO_RANK)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for a very long word: a heap of pairs over a linked list."""
        n, rank, merged = self.width, self.rank, self.merged
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank.get(a * n + b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or rank.get(ids[i] * n + ids[j]) != r:
                continue
            ids[i], ids[j] = merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (s := rank.get(ids[x] * n + ids[y])) is not None:
                    heapq.heappush(heap, (s, x))
        return [x for x in ids if x >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        found, at, end, id_of, reach = [], 0, len(word), self.id_of, self.reach
        while at < end:
            to = min(end, at + reach.get(word[at : at + 3], 2))
            while (i := id_of.get(word[at:to])) is None:
                to -= 1
            found.append(i)
            at = to
        return found

    # ---------------------------------------------------------- many words

    def _judge(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair (first * width + second) is compatible.  A token
        alone is the pair (token, none), none being the width itself."""
        wanted = np.unique(keys)
        at = np.searchsorted(self.pairs, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.pairs)
        known[inside] = self.pairs[at[inside]] == wanted[inside]
        if not known.all():
            new = wanted[~known]
            verdict = np.empty(len(new), bool)
            for k, key in enumerate(new.tolist()):
                a, b = divmod(key, self.width + 1)
                pair = [a] if b == self.width else [a, b]
                verdict[k] = self.merge(b"".join(self.bytes_of[x] for x in pair)) == pair
            if len(self.pairs) > 2 * MEMO_WORDS:
                self.pairs, self.fits = wanted[:0], verdict[:0]
                return self._judge(keys)
            where = np.searchsorted(self.pairs, new)
            self.pairs, self.fits = np.insert(self.pairs, where, new), np.insert(self.fits, where, verdict)
        return self.fits[np.searchsorted(self.pairs, keys)]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit bytes."""
        if not words:
            return []
        proposed = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        of = np.repeat(np.arange(len(words)), lengths)
        second = np.append(flat[1:], self.width)
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        second[last] = self.width
        tested = ~last | (lengths[of] == 1)  # pairs, and words of one token
        good = self._judge(flat[tested] * (self.width + 1) + second[tested])
        bad = np.unique(of[tested][~good])
        raw = flat.astype("<u4").tobytes()
        edges = np.concatenate(([0], ends)) * 4
        out = [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for k in bad.tolist():
            out[k] = np.array(self.merge(words[k]), "<u4").tobytes()
        self.all_words += len(words)
        self.exact_words += len(bad)
        return out

    def _learn_pieces(self, pieces: set[str]) -> None:
        new = list(self.pieces.unknown(pieces))
        self.pieces.now.update(zip(new, self.encode_words([p.encode() for p in new])))

    def _learn_chunks(self, chunks: set[str]) -> None:
        """A chunk stands after a blank; a line feed at its start stands for itself."""
        memo, parts = self.chunks.now, {}
        single: set[str] = set()  # chunks that are one piece with their blank
        for c in chunks:
            if c.isalpha() and (c.isascii() or max(c) < _NOT_PLAIN):
                single.add(c)
                continue
            body = c[1:] if c[:1] == "\n" else c
            if not body or body[0].isspace() or body[-1].isspace():
                memo[c] = None  # white space meets white space: not cut at blanks
            elif body is c:
                found = self.find(" " + c)
                head = found[0][1:]
                if head.isalpha():  # a word and what follows it: the word may be known
                    found[0] = head
                    if head not in memo:
                        single.add(head)
                else:
                    found.insert(0, "")
                parts[c] = found
            else:
                parts[c] = ["", "\n", *self.find(body)]
        self._learn_pieces(set(chain.from_iterable(p[1:] for p in parts.values())))
        memo.update(zip(single, self.encode_words([(" " + c).encode() for c in single])))
        piece = self.pieces.now.__getitem__
        for c, p in parts.items():
            if c not in single:
                memo[c] = b"".join([memo[p[0]] if p[0] else b"", *map(piece, p[1:])])

    # ---------------------------------------------------------------- texts

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        self.chunks.turn_over()
        self.pieces.turn_over()
        cut = [t.replace("\n", " \n").split(" ") for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(set(c[1:]).difference(self.chunks.now))
        self._learn_chunks(self.chunks.unknown(new))
        heads, tails = [], []
        for text, c in zip(texts, cut):
            first, tail = c[0], b""
            if first and not first[0].isspace() and not first[-1].isspace():
                try:
                    tail = b"".join(map(self.chunks.now.__getitem__, c[1:]))
                except TypeError:
                    first = text
            else:
                first = text
            heads.append(self.find(first))
            tails.append(tail)
        self._learn_pieces(set(chain.from_iterable(heads)))
        piece = self.pieces.now.__getitem__
        return [b"".join(map(piece, head)) + tail for head, tail in zip(heads, tails)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit bytes."""
        texts = [t or "" for t in texts]
        special = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not special:
            return self._encode_plain(texts)
        out = self._encode_plain([t if i not in set(special) else "" for i, t in enumerate(texts)])
        for i in special:
            parts = self.split(texts[i])
            plain = iter(self._encode_plain(parts[::2]))
            out[i] = b"".join(
                np.array([self.added[p]], "<u4").tobytes() if k % 2 else next(plain) for k, p in enumerate(parts)
            )
        return out

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


class LibraryBpe(Bpe):
    """The same ids, each new word encoded by the tokenizers library's own model."""

    def __init__(self, spec: str):
        super().__init__(spec)
        self.model = Tokenizer.from_str(spec).model
        self.characters = {b: c for c, b in byte_characters().items()}

    def _build_tables(self, vocab: dict[str, int], merges: list) -> None:
        """The library has its own."""

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        tokenize, characters = self.model.tokenize, self.characters
        tokens = [tokenize(w.decode("latin-1").translate(characters)) for w in words]
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        raw = array("I", [t.id for t in chain.from_iterable(tokens)]).tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]


class RankBpe(LibraryBpe):
    """The same ids by byte-pair ranks (tiktoken), for files where rank and merge list say the same.

    Ranks merge any two neighbours that together are a token, the merge list only those it names.  They agree if tokens
    are numbered in the order of the merges, each has one merge, and each comes out whole when its own bytes
    are merged: then, when a token's turn comes, the only neighbours that can make it are those its merge names, as all
    earlier merges inside its bytes are done.  This is tested when a worker builds its tables; for other files the
    library encodes the words.
    """

    def __init__(self, spec: str):
        self.ranks: dict[bytes, int] = {}
        super().__init__(spec)
        characters = self.characters
        whole = all(
            [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(characters))] == [i] for raw, i in self.ranks.items()
        )
        self.ranked = (
            tiktoken.Encoding("ranked", pat_str=_RANKED_PRETOKEN, mergeable_ranks=self.ranks, special_tokens={})
            if self.ranks and whole
            else None
        )

    def _build_tables(self, vocab: dict[str, int], merges: list) -> None:
        to_byte = byte_characters()
        merged = [vocab["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in merges]
        own = {token: i for token, i in vocab.items() if token not in self.added}
        letters = [i for token, i in own.items() if len(token) == 1]
        in_order = all(a < b for a, b in zip(merged, merged[1:])) and max(letters) < min(merged, default=len(vocab))
        if in_order and len(letters) == 256 and len(own) == 256 + len(merged):
            self.ranks = {bytes(map(to_byte.__getitem__, token)): i for token, i in own.items()}

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            return super()._encode_plain(texts)
        return [array("I", self.ranked.encode_ordinary(t)).tobytes() for t in texts]


# ------------------------------------------------------------------- Spark

_BUILT: dict[tuple[str, type], Bpe] = {}


def share(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's text, broadcast."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def built(spec: Broadcast, kind: type[Bpe] = Bpe) -> Bpe:
    """This worker's tables for the broadcast file."""
    key = hashlib.md5(spec.value.encode()).hexdigest(), kind
    if key not in _BUILT:
        _BUILT[key] = kind(spec.value)
    return _BUILT[key]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``ids`` (array of int) and
    ``decoded``, the text that decoding those ids gives back."""
    spec = share(docs.sparkSession, tokenizer)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(spec)
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                raw = bpe.encode(part.column(1).to_pylist())
                offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in raw]))).astype(np.int32)
                flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), ids, pa.array([bpe.decode(r) for r in raw], pa.string())],
                    names=[id_col, "ids", "decoded"],
                )

    return map_arrow(docs.select(id_col, text_col), step, f"`{id_col}` {id_type}, ids array<int>, decoded string")
