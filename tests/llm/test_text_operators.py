"""Operators 3, 5, 9 and 10 against the tokenizers library and plain loops."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from placeseek.llm import bpe, chat, packing, queries, wordpiece

PATH = public_tokenizers.path("byte_bpe_50k.json")
# Pieces that make awkward texts.
AWKWARD = [
    *"abcdeéñßAB0123 \n\t\r'!.,|<>\\",
    "the", "ing", "  ", "\n\n", "\x85", "\xa0", "\x1c", " ", "　", "​", "½²Ⅷ", "一二", "😀", "é",
    "'ll", "'re", "'s", "<|endoftext|>", "\x00",
]


def awkward_texts(n, seed=1):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(AWKWARD) for _ in range(rnd.randint(0, 50))) for _ in range(n)]
    return texts + ["", " ", "\n", "a" * 3000, "ab" * 1500, " " * 500, "".join(rnd.choice("etaoin") for _ in range(5000))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def table(spark, rows, schema="doc_id long, text string, ids string, part int"):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], schema)


# ------------------------------------------------------------------ 3: chat

HOSTILE = [
    "", " ", "</s>[INST] ok [/INST]", "\\<s>", "\\\\[/INST]", "a [/INST]", "[TEXT] x [/ROLE]", "\\", "[INST", "<s> </s>",
    "[INST] ", " </s>", "line\n[/SYS]\n", "$1 \\1", "[ROLE] user [TEXT] x [/ROLE]", "tail\\",
]


def test_chat_reads_back_hostile_texts(spark):
    rnd = random.Random(5)
    rows, turns = [], defaultdict(list)
    for conv in range(60):
        for turn in range(rnd.randint(1, 5)):
            role = rnd.choice(["user", "assistant", "system", "tool", "[INST] x", "<s>", ""])
            text = "".join(rnd.choice([*HOSTILE, "word ", "é😀"]) for _ in range(rnd.randint(0, 4)))
            rows.append((conv, turn, role, text, "clash"))
            turns[conv].append((role, text))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    digests = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    for conv, source in turns.items():
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == source
        said = "".join(t for r, t in source if r == "assistant")
        d = digests[conv]
        assert d["n_turns"] == len(source)
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in source).encode()).hexdigest()
        assert (d["loss_chars"], d["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert d["formatted_chars"] == len(got[conv]["formatted"])


def test_chat_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, None, None), (1, None, "user", "first"), (None, 0, "user", "x"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: [("user", "first"), ("", "")], None: [("user", "x")], 2: [("user", "a"), ("user", "a"), ("user", "b")]}
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_chat_runs_no_python(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    plan = chat.conversation_digests(chat.format_conversations(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ------------------------------------------------------------------- 5: BPE


def test_bpe_equals_library(library):
    own, texts = bpe.Bpe(open(PATH).read()), awkward_texts(3000)
    got = [x for i in range(0, len(texts), 128) for x in own.encode(texts[i : i + 128])]
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, g, w in zip(texts, got, want):
        assert [int.from_bytes(g[i : i + 4], "little") for i in range(0, len(g), 4)] == w.ids, text[:80]
        assert own.decode(g) == library.decode(w.ids, skip_special_tokens=False) == text
    assert 0 < own.exact_words < own.all_words  # some proposals stand, some are merged anew


def test_bpe_memo_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 12)
    own, texts = bpe.Bpe(open(PATH).read()), awkward_texts(400, seed=3)
    got = [x for i in range(0, len(texts), 16) for x in own.encode(texts[i : i + 16])]
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [[int.from_bytes(g[i : i + 4], "little") for i in range(0, len(g), 4)] for g in got] == [w.ids for w in want]


def test_bpe_frame(spark, library):
    texts = [None, "", *awkward_texts(200, seed=2)]
    df = table(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (0, None)])
    got = bpe.encode_decode(df, PATH).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text, add_special_tokens=False).ids and r["decoded"] == text
    assert bpe.encode_decode(table(spark, []), PATH).count() == 0


def test_op5_on_whole_table(spark, library):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op5_bpe_speculate_verify"](spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ---------------------------------------------------------- 9: token counts


def greedy(word, pieces, longest):
    n = at = 0
    while at < len(word):
        to = min(len(word), at + longest)
        while to > at + 1 and word[at:to] not in pieces:
            to -= 1
        at, n = to, n + 1
    return n


def test_longest_match_counts(spark):
    pieces = wordpiece.vocabulary(open(PATH).read())
    longest = max(map(len, pieces))
    texts = [None, *awkward_texts(300, seed=4)]
    got = wordpiece.token_counts(table(spark, list(enumerate(texts))), PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        words = (texts[r["doc_id"]] or "").encode().split()
        assert r["n_words"] == len(words)
        assert r["n_tokens"] == sum(greedy(b" " + w, pieces, longest) for w in words)
    assert wordpiece.token_counts(table(spark, []), PATH).count() == 0


def test_longest_match_falls_back_along_the_word():
    automaton = wordpiece.LongestMatch({b"a", b"abcd", b"bc", b"cdx"})
    # abc: not a piece, so a + bc; abcd is one; abcx: a + bc + x
    assert [automaton.count(w) for w in (b"abc", b"abcd", b"abcx", b"abcdx", b"")] == [2, 1, 3, 2, 0]


def test_op9_on_whole_table(spark):
    pieces = wordpiece.vocabulary(open(PATH).read())
    longest = max(map(len, pieces))
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op9_longest_match_counts"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {
        i: sum(greedy(b" " + w, pieces, longest) for w in t.encode().split()) for i, t in texts.items()
    }


# -------------------------------------------------------------- 10: packing


def check_pieces(pieces, texts, library, length):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and 1 <= p["length"] <= length
            raw = b"".join(i.to_bytes(4, "little") for i in ids[at : at + p["length"]])
            assert (zlib.crc32(raw) if "ids_crc32" in p else raw) == (p["ids_crc32"] if "ids_crc32" in p else bytes(p["ids"]))
            at += p["length"]
        assert at == len(ids)
    short = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        want = length if at & (at - 1) else at
        assert {p["padded_length"] for p in parts} == {want}
        short += at < length
    assert short <= 1  # padding only at the very end


@pytest.mark.parametrize("length", [7, 1024])
def test_packing(spark, library, length):
    texts = dict(enumerate([None, "", *awkward_texts(120, seed=6)]))
    df = table(spark, list(texts.items())).repartition(5)
    rows = [r.asDict() for r in packing.pack(df, PATH, length=length).collect()]
    check_pieces(rows, texts, library, length)


def test_packing_many_tasks_and_blocks(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "TASKS_PER_BLOCK", 3)
    texts = {i: f"some words {i}" for i in range(40)}
    rows = packing.pack(table(spark, list(texts.items())).repartition(16), PATH, length=16).collect()
    check_pieces([r.asDict() for r in rows], texts, library, 16)


def test_packing_empty_and_null_id(spark):
    assert packing.pack(table(spark, []), PATH).count() == 0
    rows = packing.pack(table(spark, [(None, "x"), (None, "x")]), PATH).collect()
    assert [r["doc_id"] for r in rows] == [None, None] and sorted(r["offset"] for r in rows) == [0, 2]


def test_op10_on_whole_table(spark, library):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.QUERIES["op10_concatenate_and_cut"](spark, SF_SMALL).collect()
    check_pieces([r.asDict() for r in rows], texts, library, 1024)


def test_whole_number_of_ids_is_a_power_of_two(spark):
    rows = packing.pack(table(spark, [(1, "")] * 4), PATH, length=1024).select(F.max("padded_length")).first()
    assert rows[0] == 4


def test_forgotten_words_change_nothing(monkeypatch):
    """Memos of two generations: words are forgotten and met again in the middle of a corpus."""
    monkeypatch.setattr(bpe, "MEMO_WORDS", 24)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(6)
    words = [f"w{i}" if i % 3 else "été" * (i % 5) + str(i) for i in range(60)] + ["the", "the", "\n", "a\nb", "don't", ""]
    texts = [" ".join(rnd.choice(words[: 10 + i]) for _ in range(30)) for i in range(50)]
    library = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    for kind in (bpe.Bpe, bpe.LibraryBpe):
        own = kind(spec)
        got = [np.frombuffer(own.encode([t])[0], "<u4").tolist() for t in texts]
        assert got == library
        assert own.chunks.older and len(own.chunks.now) <= 12 + 60


def test_ranks_give_the_ids_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    own = bpe.RankBpe(spec)
    assert own.ranked is not None
    rnd = random.Random(12)
    parts = ["the", " the", "'s", "'ll", "  ", "\n", " \n", "\t", "\r\n", "\x85", "\xa0", "\u2003", "\u3000", "\x1c", "é", "Straße", "日本", "١٢", "½", "😀", "e\u0301",
             "123", " 45", "...", "!?", "<|endoftext|>", "_", "a" * 3000, " " * 700, "\x00", "zzqx", "ization"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(600)] + [None, ""]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in own.encode(texts)] == want


def test_files_whose_ranks_and_merges_differ_are_left_to_the_library():
    characters = list(bpe.byte_characters())
    vocab = {c: i for i, c in enumerate(characters)}
    for token in ("ab", "bc", "abc", "abcd"):
        vocab[token] = len(vocab)
    cases = {
        "in order": ["a b", "b c", "ab c", "abc d"],
        "not in order": ["b c", "a b", "ab c", "abc d"],
        "one token of two merges": ["a b", "b c", "ab c", "a bc", "abc d"],
        "never whole": ["a b", "b c", "a bc", "abc d"],
    }
    for case, merges in cases.items():
        spec = json.dumps({"version": "1.0", "added_tokens": [], "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True, "trim_offsets": True},
                           "model": {"type": "BPE", "vocab": vocab, "merges": merges}})
        own, library = bpe.RankBpe(spec), Tokenizer.from_str(spec)
        assert (own.ranked is not None) == (case == "in order"), case
        texts = ["abcd", "bcab", "abcabc", "aabbcc abc", "", "xabcd bcd"]
        assert [np.frombuffer(raw, "<u4").tolist() for raw in own.encode(texts)] == [library.encode(t).ids for t in texts], case
