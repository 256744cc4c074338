"""Word matching (JON3, JON4, FLT1, FLT2).

The terms of one search text are literals: each word row looks up the terms
that its length allows and is tested in place (no shuffle, no broadcast).  Many terms are a
small table: each distinct word meets those it shares a rest with, and the rows are picked by the words found.  A table of searches is an equi-join:
``fuzzy_join`` meets words and terms on pieces that two texts within the
distance must share.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions.distance import candidates, deletions, near_any, within_distance
from placeseek.functions.phonetic import soundex_code
from placeseek.functions.text import explode_words, split_terms
from placeseek.operators.joins import DEFAULT_BROADCAST_ROWS, is_small
from placeseek.session import stored

# Fixed value: the reference keeps words at distance < 3 from a term.
DISTANCE_LIMIT = 3
#: More terms than this are not tested against every row.
MANY_TERMS = 32
#: Terms whose rests one search broadcasts.
BROADCAST_TERMS = 5_000
_HAS_LETTER = re.compile("[A-Za-z]")


def fuzzy_filter(
    words: DataFrame,
    text: str | None,
    word_col: str = "palavras",
    limit: int = DISTANCE_LIMIT,
) -> DataFrame:
    """JON3 + FLT1/FLT2: rows whose word is within ``limit - 1`` edits of a term.

    Same rows as the reference's two explodes and ``levenshtein < limit``:
    terms are OR-ed, the search ``''`` (or a leading/trailing blank) adds
    the term ``''``, a null search text matches nothing.
    """
    return rows_near(words, split_terms(text), word_col, limit)


def rows_near(words: DataFrame, terms: Sequence[str], word_col: str, limit: int) -> DataFrame:
    """Rows whose word is within ``limit - 1`` edits of one of ``terms``.

    A few terms are tested in place.  With many, a word that occurs in a thousand rows is looked at
    once, and tested only against the terms it shares a rest with; the words found are written
    and the rows joined to them (by broadcast if they are measured as small).
    """
    terms = list(dict.fromkeys(terms))
    if len(terms) <= MANY_TERMS or limit <= 0 or words.isStreaming:
        return words.filter(near_any(word_col, terms, limit))
    known = words.select(F.col(word_col).alias("_near")).distinct()
    found = stored(_near_words(known, terms, limit), "near-words")
    if is_small(found, DEFAULT_BROADCAST_ROWS):
        found = F.broadcast(found)
    return words.join(found, F.col(word_col) == F.col("_near"), "left_semi")


def _near_words(known: DataFrame, terms: Sequence[str], limit: int) -> DataFrame:
    """Those of the distinct words ``known`` (``_near``) that are within ``limit - 1`` edits of one of ``terms``."""
    one = known.sparkSession.range(1)
    asked = one.select(F.explode(F.from_json(F.lit(json.dumps(list(terms))), "array<string>")).alias("_term"))
    asked = asked.select("_term", F.explode(deletions(F.col("_term"), limit - 1)).alias("_rest"))
    if len(terms) <= BROADCAST_TERMS:
        asked = F.broadcast(asked)
    met = known.select("_near", F.explode(deletions(F.col("_near"), limit - 1)).alias("_rest")).join(asked, "_rest")
    return met.where(within_distance("_near", F.col("_term"), limit)).select("_near").distinct()


def length_bands(length_col: str, terms: Sequence[str], limit: int = DISTANCE_LIMIT) -> Column:
    """True for word lengths from which fewer than ``limit`` edits lead to one of ``terms``.

    Bands that touch are one range, so the condition stays small for any number of terms, and as a
    condition on a column it reaches the scan of a stored corpus.
    """
    ranges: list[list[int]] = []
    for n in sorted({len(t) for t in terms}):
        low, high = max(0, n - limit + 1), n + limit - 1
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1][1] = high
        else:
            ranges.append([low, high])
    return reduce(lambda a, b: a | b, [F.col(length_col).between(*r) for r in ranges], F.lit(False))


def fuzzy_pairs(
    words: DataFrame,
    text: str | None,
    word_col: str = "palavras",
    limit: int = DISTANCE_LIMIT,
    term_col: str = "parameters",
) -> DataFrame:
    """JON3 in the reference's own row shape: one row per (word row, term)
    within ``limit - 1`` edits, the term in ``term_col``.  A term typed
    twice matches twice, as the reference's explode of the terms does.

    Each word row builds the array of its matching terms (one bounded test
    per term, nulls dropped) and explodes that, so only matches are ever
    emitted; the rows are not multiplied by the terms before the test.
    """
    terms = split_terms(text)
    if not terms:
        return words.limit(0).withColumn(term_col, F.lit(None).cast("string"))
    pairs = words.select("*", F.explode(candidates(word_col, terms, limit)).alias(term_col))
    return pairs.filter(F.levenshtein(word_col, term_col, limit - 1) >= 0)


def fuzzy_join(
    words: DataFrame,
    searches: DataFrame,
    parameter_col: str = "parameter",
    word_col: str = "palavras",
    limit: int = DISTANCE_LIMIT,
    term_col: str = "parameters",
) -> DataFrame:
    """JON3 for a table of searches: ``words`` x ``searches`` rows where the word is
    within ``limit - 1`` edits of a term of ``parameter_col`` (split on blanks), with that
    term in ``term_col``; a term typed twice matches twice.

    A term is cut into ``limit`` pieces.  With fewer than ``limit`` edits one piece
    comes through unchanged, moved by fewer than ``limit`` places, so each
    distinct word and term meet in an equi-join on (length of the term, number and text
    of the piece) and only pairs that share a piece are tested.  The tested pairs are
    then joined back to both tables by their texts.
    """
    asked = searches.select("*", explode_words(parameter_col).alias(term_col))
    n = F.length("_term")
    term_pieces = [
        (i, F.substring(F.col("_term"), F.floor(n * i / limit).cast("int") + 1, (F.floor(n * (i + 1) / limit) - F.floor(n * i / limit)).cast("int")))
        for i in range(limit)
    ]
    terms = asked.select(F.col(term_col).alias("_term")).distinct()
    terms = terms.select("_term", F.explode(F.array(*[F.struct(n.alias("n"), F.lit(i).alias("i"), p.alias("p")) for i, p in term_pieces])).alias("_key"))

    # the same pieces as each word would show them, for every term length and shift
    found = words.select(F.col(word_col).alias("_word")).distinct()
    size, length = F.length("_word"), F.col("_n")
    found = found.select("_word", F.explode(F.sequence(F.greatest(F.lit(0), size - limit + 1), size + limit - 1)).alias("_n"))
    keys = []
    for i in range(limit):
        start, end = F.floor(length * i / limit).cast("int"), F.floor(length * (i + 1) / limit).cast("int")
        for shift in range(-limit + 1, limit):
            at = start + shift
            piece = F.substring(F.col("_word"), at + 1, end - start)
            fits = (at >= 0) & (at + end - start <= size)
            keys.append(F.when(fits, F.struct(length.alias("n"), F.lit(i).alias("i"), piece.alias("p"))))
    found = found.select("_word", F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("_key"))
    pairs = found.join(terms, "_key").select("_word", "_term").distinct()
    pairs = pairs.where(F.levenshtein("_word", "_term", limit - 1) >= 0)
    matched = words.join(pairs, F.col(word_col) == F.col("_word")).drop("_word")
    return matched.join(asked, F.col("_term") == F.col(term_col)).drop("_term")


def term_codes(spark: SparkSession, terms: Sequence[str]) -> list[str]:
    """The sound code of each term, by the same expression as the words' (one constant row)."""
    known = F.from_json(F.lit(json.dumps(list(terms))), "array<string>")
    return spark.range(1).select(F.transform(known, lambda t: soundex_code(t))).first()[0]


def _coded_terms(words: DataFrame, text: str | None) -> list[tuple[str, str]]:
    """(code, term) of the terms of ``text`` that have a code; without an ASCII letter a term
    has the empty code and matches nothing."""
    terms = [t for t in split_terms(text) if _HAS_LETTER.search(t)]
    return list(zip(term_codes(words.sparkSession, terms), terms)) if terms else []


def _sounds_like(coded: Sequence[tuple[str, str]], word_col: str) -> Column:
    # A code starts with the word's first ASCII letter, upper-cased.  Words
    # that start with such a letter and a different one cannot match, so a
    # one-character test spares them the regex and the coding (exact: a word
    # starting with anything else still takes the full test).
    heads = sorted({_HAS_LETTER.search(t).group().upper() for _, t in coded})
    first = F.substring(word_col, 1, 1)
    ascii_head = first.between("A", "Z") | first.between("a", "z")
    return (~ascii_head | F.upper(first).isin(*heads)) & soundex_code(word_col).isin(*sorted({c for c, _ in coded}))


def phonetic_filter(
    words: DataFrame,
    text: str | None,
    word_col: str = "palavras",
) -> DataFrame:
    """JON4: rows whose word has the same sound code as one of the terms.

    The terms' codes are literals, so the test is one lookup in a constant
    set per word, for any number of terms.  Terms with no
    ASCII letter (empty code) match nothing.
    """
    coded = _coded_terms(words, text)
    return words.filter(_sounds_like(coded, word_col)) if coded else words.limit(0)


def phonetic_pairs(
    words: DataFrame,
    text: str | None,
    word_col: str = "palavras",
    term_col: str = "parameters",
) -> DataFrame:
    """JON4 as an equi-join of words and terms on the sound code: one row per
    (word row, term) with equal codes, the term in ``term_col``.

    The typed terms are one constant, a map from code to terms: a word that
    passes ``phonetic_filter`` looks its terms up and explodes them.
    """
    coded = _coded_terms(words, text)
    if not coded:
        return words.limit(0).withColumn(term_col, F.lit(None).cast("string"))
    by_code: dict[str, list[str]] = {}
    for code, term in coded:
        by_code.setdefault(code, []).append(term)
    hits = F.element_at(F.from_json(F.lit(json.dumps(by_code)), "map<string, array<string>>"), soundex_code(word_col))
    return words.filter(_sounds_like(coded, word_col)).select(*words.columns, F.explode(hits).alias(term_col))
