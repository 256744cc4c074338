"""Search documents (PIPE4), word corpus (PIPE5) and fuzzy search (PIPE6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions.text import explode_words, search_text, split_terms
from placeseek.operators.aggregate import distinct_rows
from placeseek.operators.limit import page_of_rows
from placeseek.operators.project import RECORD_FIELDS, rename_columns, to_city_record
from placeseek.operators.search import DISTANCE_LIMIT, fuzzy_filter, length_bands, phonetic_filter, rows_near

# Country-workbook headers, their names in the corpus, and
# the columns of the search text (in order).
WORKBOOK_RENAMES = {
    "Municípios": "municipio",
    "SKU Município": "sku_municipio",
    "SKU País": "sku_pais",
    "Tipo": "tipo",
    "H": "h",
    "CEP": "cep",
}
SEARCH_COLUMNS = ("linha", "municipio", "tipo", "h", "cep", "sku_pais", "sku_municipio")
INDEX_RENAMES = {"sku_municipio": "skuMunicipio", "sku_pais": "skuPais"}
TEXT_COL = "search_phonetic"
WORD_COL = "palavras"


def search_documents(
    workbook: DataFrame,
    cols: Sequence[str] = SEARCH_COLUMNS,
    renames: Mapping[str, str] = INDEX_RENAMES,
) -> DataFrame:
    """PIPE4: one search document per row: ``cols`` plus their joined text.

    Not de-duplicated (the reference de-duplicates only its preview).
    """
    docs = workbook.select(*cols, search_text(cols).alias(TEXT_COL))
    return rename_columns(docs, renames)


def word_corpus(
    table: DataFrame,
    cols: Sequence[str] = SEARCH_COLUMNS,
    text_col: str = TEXT_COL,
    word_col: str = WORD_COL,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """PIPE5: one row per word of the search text of each row.

    With ``cols`` the text is built from them (PIPE4's text); with
    ``cols=None`` the existing ``text_col`` is split.  ``keep`` lists the
    columns carried next to each word (default: ``cols`` and the text).
    The explode is a narrow operation: words stay in the task of their row.
    """
    base = table.withColumn(text_col, search_text(cols)) if cols else table
    carried = list(keep) if keep is not None else [*(cols or []), text_col]
    return base.select(*carried, explode_words(text_col).alias(word_col))


def fuzzy_matches(
    corpus: DataFrame,
    text: str | None,
    cols: Sequence[str] = SEARCH_COLUMNS,
    word_col: str = WORD_COL,
    limit: int = DISTANCE_LIMIT,
) -> DataFrame:
    """PIPE6 before its limit: the distinct ``cols`` of rows with a word
    within ``limit - 1`` edits of a search term."""
    return distinct_rows(fuzzy_filter(corpus, text, word_col, limit), cols)


def fuzzy_search(
    corpus: DataFrame,
    text: str | None,
    n: int = 10,
    page: int = 1,
    fields: Mapping[str, str] = RECORD_FIELDS,
    word_col: str = WORD_COL,
    limit: int = DISTANCE_LIMIT,
) -> DataFrame:
    """PIPE6: typo-tolerant search, as a page of 7-field records.

    Matching rows are de-duplicated on the record's source columns, mapped
    to the record, and the requested page taken in order of all fields.
    """
    found = fuzzy_matches(corpus, text, list(fields.values()), word_col, limit)
    records = to_city_record(found, fields)
    return page_of_rows(records, page, n)


def phonetic_matches(
    corpus: DataFrame,
    text: str | None,
    cols: Sequence[str] = SEARCH_COLUMNS,
    word_col: str = WORD_COL,
) -> DataFrame:
    """JON4 as a search: distinct ``cols`` of rows with a word that sounds
    like (same Soundex code as) a search term."""
    return distinct_rows(phonetic_filter(corpus, text, word_col), cols)


# Row-group size of a stored corpus: smaller groups give the length filter
# finer pieces to skip.
CORPUS_ROW_GROUP_BYTES = 16 * 1024 * 1024
LENGTH_COL = "wlen"


def store_corpus(corpus: DataFrame, path: str, word_col: str = WORD_COL) -> None:
    """Write a word corpus for repeated searches (departure D9).

    Each task sorts its rows by word length before writing, so every
    Parquet row group covers a narrow band of lengths and carries min/max
    statistics for it.  No shuffle: the order is only within each file.
    """
    (
        corpus.withColumn(LENGTH_COL, F.length(word_col))
        .sortWithinPartitions(LENGTH_COL)
        .write.mode("overwrite")
        .option("parquet.block.size", CORPUS_ROW_GROUP_BYTES)
        .parquet(path)
    )


def stored_fuzzy_filter(
    stored: DataFrame, text: str | None, word_col: str = WORD_COL, limit: int = DISTANCE_LIMIT
) -> DataFrame:
    """``fuzzy_filter`` on a stored corpus, with the length bound pushed to
    the scan: a word within ``limit - 1`` edits of a term has a length
    within ``limit - 1`` of the term's, so row groups whose length range
    misses every term's band are skipped unread.  Exact."""
    terms = list(dict.fromkeys(split_terms(text)))
    if not terms:
        return stored.limit(0)
    return rows_near(stored.filter(length_bands(LENGTH_COL, terms, limit)), terms, word_col, limit)


def register_search_function(
    spark: SparkSession, view: str, cols: Sequence[str], name: str = "fuzzy_words", word_col: str = WORD_COL,
    limit: int = DISTANCE_LIMIT,
) -> None:
    """UDF1 + JON3: the search as a table function in SQL, ``SELECT * FROM fuzzy_words('text')``.

    Its body is the distance test over the corpus registered as ``view``, in built-in expressions, so a query
    around it is planned as one: its own filters and columns reach the scan of the corpus.
    """
    types = {f.name: f.dataType.simpleString() for f in spark.table(view).schema.fields}
    returned = ", ".join(f"`{c}` {types[c]}" for c in [*cols, word_col])
    near = f"abs(length(`{word_col}`) - length(t)) < {limit} AND levenshtein(`{word_col}`, t, {limit - 1}) >= 0"
    columns = ", ".join(f"`{c}`" for c in [*cols, word_col])
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(search STRING) RETURNS TABLE ({returned}) "
        f"RETURN SELECT {columns} FROM `{view}` WHERE exists(split({name}.search, '\\\\s+'), t -> {near})"
    )
