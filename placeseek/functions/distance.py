"""Edit-distance predicates (FN6, FLT1, FLT2).

``levenshtein(a, b) < k`` is rewritten, exactly, as

    abs(length(a) - length(b)) < k  AND  levenshtein(a, b, k - 1) >= 0

The length test is a cheap necessary condition and the bounded form of
Spark's ``levenshtein`` stops as soon as the distance passes ``k - 1``
(it returns -1).  Both count characters, not bytes, and are case-sensitive.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeseek.functions.text import ColumnLike, _col


#: Characters of a word's beginning whose deletions are kept: a bound on the
#: neighbours of a word, however long it is.
PREFIX = 8


def within_distance(word: ColumnLike, term: Column | str, limit: int) -> Column:
    """``edit_distance(word, term) < limit`` in its bounded, exact form.

    ``word`` is a column (or column name); ``term`` is a Column or, when a
    Python ``str``, a literal search term whose length is known up front.
    """
    w = _col(word)
    if isinstance(term, str):
        t, t_len = F.lit(term), F.lit(len(term))
    else:
        t, t_len = term, F.length(term)
    if limit <= 0:
        return F.lit(False)
    return (F.abs(F.length(w) - t_len) < limit) & (F.levenshtein(w, t, limit - 1) >= 0)


def terms_by_length(terms: Sequence[str], limit: int) -> Column:
    """A literal array: at each length of a word, the terms it may match.

    Read from one string literal, which the optimizer folds into a constant, so
    the predicate over it is the same small expression for two terms and for thousands.
    """
    bands: list[list[str]] = [[] for _ in range(max(map(len, terms), default=0) + limit)]
    for t in terms:
        for n in range(max(0, len(t) - limit + 1), len(t) + limit):
            bands[n].append(t)
    return F.from_json(F.lit(json.dumps(bands)), "array<array<string>>")


def candidates(word: ColumnLike, terms: Sequence[str], limit: int) -> Column:
    """The terms whose length allows a match with ``word`` (null: none)."""
    return F.get(terms_by_length(terms, limit), F.length(_col(word)))


def near_any(word: ColumnLike, terms: Sequence[str], limit: int) -> Column:
    """True when ``word`` is within ``limit - 1`` edits of one of ``terms``.

    Each word looks up the terms of its length's band and tests those; no row
    is multiplied by the terms.
    """
    if not terms or limit <= 0:
        return F.lit(False)
    w = _col(word)
    hit = F.exists(candidates(w, list(dict.fromkeys(terms)), limit), lambda t: F.levenshtein(w, t, limit - 1) >= 0)
    return F.coalesce(hit, F.lit(False))


def deletions(word: Column, edits: int) -> Column:
    """The distinct rests of the first ``PREFIX`` characters of ``word`` after up to ``edits`` deletions (null: none).

    Words within ``edits`` edits share one: an alignment of the two words deletes at most ``edits`` characters
    of either beginning; if the beginnings do not end at the same place of it, what one of them has too much is
    among the deletions still left to it.  Each rest is written out as the pieces that stay.
    """
    rests = []
    for k in range(min(edits, PREFIX) + 1):
        for gone in combinations(range(PREFIX), k):
            starts, ends = [0, *[g + 1 for g in gone]], [*gone, PREFIX]
            pieces = [F.substring(word, a + 1, b - a) for a, b in zip(starts, ends) if b > a]
            rest = F.concat(F.lit(""), *pieces)
            rests.append(F.when(F.length(word) > gone[-1], rest) if gone else rest)
    return F.array_distinct(F.array_compact(F.array(*rests)))
