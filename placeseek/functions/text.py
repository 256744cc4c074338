"""Text functions (FN1-FN5) as built-in Column expressions.

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word separator of the search text and the corpus is the
# Java regular expression \s+ (ASCII blanks only: space, tab, newline,
# vertical tab, form feed, carriage return).  A no-break space is not one.
WORD_SEPARATOR = r"\s+"
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: ColumnLike) -> Column:
    """FN1: first letter of each space-separated part upper, rest lower."""
    return F.initcap(_col(c))


def search_text(cols: Sequence[ColumnLike], sep: str = " ") -> Column:
    """FN2/FN3: join columns with ``sep``; nulls skipped, ints cast to text."""
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])


def split_words(c: ColumnLike) -> Column:
    """FN4: split on runs of blanks; leading/trailing blanks give ''."""
    return F.split(_col(c), WORD_SEPARATOR)


def explode_words(c: ColumnLike) -> Column:
    """FN4 + FN5: one row per word; a null text gives no row."""
    return F.explode(split_words(c))


def split_terms(text: str | None) -> list[str]:
    """Split a user's search text the way ``split_words`` splits a column.

    The search text is a single parameter that already lives on the driver;
    splitting it here lets each term become a literal in the predicate.
    ``None`` gives no terms (the reference's explode of a null array).
    """
    if text is None:
        return []
    return _BLANKS.split(text)
