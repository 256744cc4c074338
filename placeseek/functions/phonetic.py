"""Sound codes (FN7, FN8) and their SQL names (UDF1-UDF3).

Soundex is Spark's built-in ``soundex`` applied after dropping every
character that is not an ASCII letter.  Dropping first makes the built-in
agree with the classic codec on inputs such as ``12ab`` (A100) and
`` Hello`` (H400), and turns accented letters, on which the codec fails,
into a defined result: they are left out.  An optional accent fold maps
them to their base letter instead.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from placeseek.functions.text import ColumnLike, _col

# Accented letters and their base letters, for the optional
# fold before coding (same position in both strings).
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
UNACCENTED = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"

LETTERS_ONLY = "[^A-Za-z]"


def fold_accents(c: ColumnLike) -> Column:
    return F.translate(_col(c), ACCENTED, UNACCENTED)


def soundex_code(c: ColumnLike, fold: bool = False) -> Column:
    """FN7: four-character Soundex of the ASCII letters of ``c``.

    ``''`` (or a text with no ASCII letter) gives ``''``; null gives null.
    """
    text = fold_accents(c) if fold else _col(c)
    return F.soundex(F.regexp_replace(text, LETTERS_ONLY, ""))


def phonetic_code(c: ColumnLike) -> Column:
    """FN8 + UDF3 re-aimed: lower-case, then the sound code of FN7."""
    return soundex_code(F.lower(_col(c)))


def register_sql_functions(spark: SparkSession) -> None:
    """UDF1-UDF3: make ``soundex_udf`` and ``phonetic_code`` callable in SQL.

    They are SQL functions whose bodies are built-in expressions, so a query
    that calls them keeps codegen; no Python runs per row.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION soundex_udf(s STRING) "
        "RETURNS STRING RETURN soundex(regexp_replace(s, '[^A-Za-z]', ''))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION phonetic_code(s STRING) "
        "RETURNS STRING RETURN soundex(regexp_replace(lower(s), '[^A-Za-z]', ''))"
    )
