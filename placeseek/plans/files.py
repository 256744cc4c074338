"""The reference's file-based pipelines: workbooks and a states CSV in,
enriched cities or search documents out (PIPE1, PIPE3, PIPE4, PIPE5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from placeseek.operators.aggregate import distinct_rows, row_count
from placeseek.operators.project import rename_columns
from placeseek.plans.enrich import CITY_RENAMES, enrich_cities, enrich_cities_as_reference, prepare_cities, prepare_states
from placeseek.plans.search import WORKBOOK_RENAMES, search_documents
from placeseek.sinks.index import json_lines, preview_then_append
from placeseek.sources.excel import read_workbooks
from placeseek.sources.files import infer_excel_schema
from placeseek.sources.tables import read_csv_strings

# The municipalities workbook has 12 text columns, in this
# order; the country workbooks have ``linha`` (int) and 6 text columns.
CITY_SCHEMA = StructType([StructField(name, StringType(), True) for name in CITY_RENAMES])
COUNTRY_SCHEMA = StructType(
    [
        StructField("linha", IntegerType(), True),
        StructField("Municípios", StringType(), True),
        StructField("Tipo", StringType(), True),
        StructField("H", StringType(), True),
        StructField("CEP", StringType(), True),
        StructField("SKU País", StringType(), True),
        StructField("SKU Município", StringType(), True),
    ]
)


def read_excel(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer: bool = False,
    empty_as_null: bool = False,
) -> DataFrame:
    """SRC1-SRC3 with the reference's options (header on, empties kept).

    A schema is matched to the sheets' columns by position.  ``infer=True`` without a schema
    derives names and exact types from every cell of every workbook in one distributed pass.
    Without either, the columns are the same and all are text.
    """
    if schema is None:
        schema = infer_excel_schema(spark, path, typed=infer)
    return read_workbooks(spark, path, schema, empty_as_null)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """SRC1 + PRJ1: municipalities workbook(s), columns renamed."""
    return prepare_cities(read_excel(spark, path, CITY_SCHEMA))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """SRC4 + PRJ1: the regions/states CSV, all text, columns renamed."""
    return prepare_states(read_csv_strings(spark, path))


def enrich_from_files(spark: SparkSession, cities_path: str, states_path: str, twice: bool = False) -> DataFrame:
    """PIPE1 end to end: 12 city columns, ``paisCamel``, state name and
    continent.  ``twice`` joins the states a second time, as the source application
    does (k * k rows for a state key that stands k times)."""
    enrich = enrich_cities_as_reference if twice else enrich_cities
    return enrich(read_cities(spark, cities_path), read_states(spark, states_path))


def enrich_and_index(
    spark: SparkSession,
    cities_path: str,
    states_path: str,
    target: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    preview_rows: int = 10,
    twice: bool = False,
) -> list[Row]:
    """PIPE1 as the source application runs it: enrich, show a preview, and
    append the 15-column documents to the index ``target`` through ``fmt``.
    Returns the preview rows."""
    enriched = enrich_from_files(spark, cities_path, states_path, twice)
    return preview_then_append(enriched, target, fmt, preview_rows, options)


def index_search_documents(
    spark: SparkSession,
    pattern: str,
    target: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    preview_rows: int = 10,
) -> list[Row]:
    """PIPE4 end to end: country workbooks -> 8-column search documents, a preview
    of distinct ones, and the append of all to the index ``target``."""
    docs = search_documents(read_country_workbooks(spark, pattern))
    return preview_then_append(docs, target, fmt, preview_rows, options, shown=distinct_rows(docs))


def read_country_workbooks(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC2 + PRJ1: every country workbook matching ``pattern`` as one table."""
    return rename_columns(read_excel(spark, pattern, COUNTRY_SCHEMA), WORKBOOK_RENAMES)


def dump_workbooks(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame]:
    """PIPE3: the workbooks' rows as JSON lines, and their row count."""
    table = read_excel(spark, pattern, COUNTRY_SCHEMA)
    return json_lines(table), row_count(table)
