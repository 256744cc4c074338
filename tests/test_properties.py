"""Randomised checks against independent, plain definitions."""

import random


from placeseek.functions import near_any, soundex_code

# The American Soundex letter groups (test oracle only).
GROUPS = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}
CODE = {ch: d for letters, d in GROUPS.items() for ch in letters}


def soundex_plain(word):
    """Textbook American Soundex of the ASCII letters of ``word``."""
    if word is None:
        return None
    letters = [c.upper() for c in word if c.isascii() and c.isalpha()]
    if not letters:
        return ""
    out, last = [letters[0]], CODE.get(letters[0], "")
    for ch in letters[1:]:
        d = CODE.get(ch, "")
        if ch in "HW":
            continue  # H and W do not separate equal codes
        if d and d != last:
            out.append(d)
        last = d  # a vowel (no code) separates equal codes
    return ("".join(out) + "000")[:4]


def levenshtein_plain(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


ALPHABET = "abcdehlmnorstwAEHRSTWé'ßı -1"


def _words(rng, n, max_len=9):
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


def test_soundex_matches_plain_definition(spark):
    rng = random.Random(7)
    words = _words(rng, 2000) + ["Ashcraft", "Pfister", "Tymczak", "Honeyman", "Hhwb", "bhb"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", soundex_code("w").alias("c"))
    for row in got.collect():
        assert row.c == soundex_plain(row.w), row.w


def test_bounded_search_matches_plain_distance(spark):
    rng = random.Random(11)
    words = _words(rng, 3000)
    terms = _words(rng, 3, max_len=6)
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    for limit in (1, 2, 3):
        got = {r.i for r in df.filter(near_any("w", terms, limit)).collect()}
        want = {i for i, w in enumerate(words) if any(levenshtein_plain(w, t) < limit for t in terms)}
        assert got == want, (limit, terms)
