"""Operator 11 against Python's own regular expressions."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from placeseek.llm.automata import compile_patterns
from placeseek.llm.secrets import BASE_RULES, LANE, MORE_RULES, Rule, Scanner, _longest, find_secrets

PARTS = (
    "password PassWd secret token toKen api_key apikey = : \" ' AKIA A1B2C3D4E5F6G7H8 0123456789abcdef deadbeef abc é ſ K x word K9 "
    ".... AKIAKIA eyJab .cd ghp_"
).split() + ["-----BEGIN PRIVATE KEY-----", " ", "   " * 250, "\n", "a" * 30, "a1" * 400, "Zz9" * 14, "\x01", "\x00"]


def _plain(rule):
    """The rule as a Python expression: group 1 is the head, ASCII letters fold only."""
    head = re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]) + ")", rule.head)
    return re.compile(f"({head})({rule.tail}+)" if rule.tail else f"({head})()")


def brute(text, rules):
    found = []
    for i, rule in enumerate(rules):
        for m in _plain(rule).finditer(text or ""):
            if not rule.tail or len(m[2]) >= rule.least:
                found.append((m.start(), i, m.end()))
    return [(rules[i].kind, a, b) for a, i, b in sorted(found)]


RULES = (*BASE_RULES, *MORE_RULES)
SCANNER = Scanner(RULES)


def _scan(texts):
    return SCANNER.spans([None if t is None else t.encode() for t in texts])


def test_scanner_equals_regular_expressions():
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + [None, "", "é"]
    got = _scan(texts)
    assert got == [brute(t, RULES) for t in texts]
    assert {k for spans in got for k, _, _ in spans} == {r.kind for r in RULES}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=5))
def test_any_texts(texts):
    assert _scan(texts) == [brute(t, RULES) for t in texts]


def test_matches_longer_than_a_lane_and_a_failing_match_uses_up_its_text():
    value = "q" * (5 * LANE + 3)
    text = "x" * 300 + "token" + " " * (3 * LANE) + "= '" + value + "' password=token:abcdefgh " + "0f" * (4 * LANE)
    assert _scan([text]) == [brute(text, RULES)]
    # the five letters after password= fail, and "token:..." starts inside them
    assert _scan(["password=token:abcdefgh"]) == [[]]


def test_patterns_of_the_compiler():
    for pattern in [r"a{2,4}b?", r"(ab|ba)+c", r"[a-c]{3}", r"a(b{0,2}c)*", r"\x61[b\-]+", r"ab|ab*c", r"(?i:k)e{1}"]:
        a = compile_patterns([pattern])
        plain = re.compile("(?a)" + re.sub(r"\(\?i:k\)", "[kK]", pattern))
        rnd = random.Random(pattern)
        for _ in range(300):
            text = "".join(rnd.choice("abcKke-") for _ in range(rnd.randint(0, 9)))
            ends = [e for e in range(len(text), 0, -1) if plain.fullmatch(text, 0, e)]
            assert _longest(a, text.encode(), 0) == (ends[0] if ends else 0), (pattern, text)


def test_rules_are_a_parameter(spark):
    docs = spark.createDataFrame(
        [(1, "call 555-1234 now", "x"), (1, "call 555-1234 now", "x"), (None, "5-5", "y"), (3, None, None), (4, "", "z")],
        "doc_id long, text string, spans string",
    )
    got = find_secrets(docs, [Rule("phone", "[0-9]+-", "[0-9]", 4)]).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=str) == sorted(
        [(1, [("phone", 5, 13)]), (1, [("phone", 5, 13)]), (None, []), (3, []), (4, [])], key=str
    )
    assert find_secrets(docs.limit(0)).count() == 0


def test_long_text(spark):
    text = "Wort für Wort, " * 40_000 + "secret: abcdefgh " + "ß" * 5 + " AKIA" + "7" * 16
    docs = spark.createDataFrame([(9, text)], "doc_id long, text string")
    [row] = find_secrets(docs).collect()
    assert [tuple(s) for s in row.spans] == brute(text, RULES)
