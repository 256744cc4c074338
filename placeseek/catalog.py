"""Registered queries on the driver's tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables.  ``ORACLES`` holds, for the same name, an independent
SQL formulation that DuckDB runs on the same Parquet files.  Column names
match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from placeseek.fixtures import write_workbooks
from placeseek.functions.phonetic import phonetic_code, register_sql_functions, soundex_code
from placeseek.functions.text import explode_words, search_text, title_case
from placeseek.operators.aggregate import distinct_rows, first_distinct_rows, row_count
from placeseek.operators.joins import left_join, left_join_twice
from placeseek.operators.limit import first_rows, page_of_rows
from placeseek.operators.pages import rows_after, store_pages, stored_page
from placeseek.operators.project import (
    rename_columns,
    select_aliased,
    to_city_record,
    with_columns,
    with_search_parameter,
)
from placeseek.operators.search import fuzzy_filter, fuzzy_join, fuzzy_pairs, phonetic_filter, phonetic_pairs
from placeseek.plans.enrich import (
    CITY_RENAMES,
    STATE_RENAMES,
    city_preview,
    enrich_cities,
    enrich_cities_as_reference,
)
from placeseek.plans.files import (
    CITY_SCHEMA,
    COUNTRY_SCHEMA,
    dump_workbooks,
    enrich_and_index,
    enrich_from_files,
    index_search_documents,
    read_cities,
    read_country_workbooks,
    read_excel,
)
from placeseek.plans.search import (
    fuzzy_matches,
    fuzzy_search,
    phonetic_matches,
    register_search_function,
    search_documents,
    store_corpus,
    stored_fuzzy_filter,
    word_corpus,
)
from placeseek.plans.ingest import ingest_new, ingested
from placeseek.plans.sound_table import sound_pairs, store_sound_table, words_like
from placeseek.plans.word_index import (
    WordIndex,
    build_word_index,
    indexed_documents,
    indexed_fuzzy_join,
    indexed_terms_filter,
)
from placeseek.plans.shapes import part_as_workbook, states_from_nation
from placeseek.session import scratch_path, spread
from placeseek.sinks.index import append_to_index, collect_records, json_lines, register_view, write_json_lines
from placeseek.sources.blocks import read_workbook_blocks
from placeseek.sources.files import column_audit, drift_report, list_files
from placeseek.sources.tables import read_csv_strings, read_table, read_view

Query = Callable[[SparkSession, str], DataFrame]

# The search texts used by the registered searches.
PART_SEARCH = "smal rng"
DOC_SEARCH = "erblest therouou"
SOUND_SEARCH = "erblest therouou"
PART_SOUND_SEARCH = "smol rinj"
# The whole-number and text columns of customer (doubles stay out of
# text forms, whose spelling differs between engines).
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
# The syllables of which 1,000 search terms are made.
SYLLABLES = ("the", "an", "er", "ing", "tion", "ea", "ou", "st", "nd", "wh")
SEARCH_DOC_SCHEMA = (
    "linha int, municipio string, tipo string, h string, cep string, "
    "skuPais string, skuMunicipio string, search_phonetic string"
)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------- joins, PIPE1


def q_enrich_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = states_from_nation(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))
    return enrich_cities(
        _t(spark, sf_dir, "customer"),
        states,
        on=[("c_nationkey", "n_nationkey")],
        country_col="c_mktsegment",
    )


def q_enrich_cities_as_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = states_from_nation(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))
    return enrich_cities_as_reference(
        _t(spark, sf_dir, "customer"),
        states,
        on=[("c_nationkey", "n_nationkey")],
        country_col="c_mktsegment",
    )


def q_left_join_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return left_join(li, od, [("l_orderkey", "o_orderkey"), ("l_linestatus", "o_orderstatus")])


def q_left_join_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", "l_linenumber", "l_partkey")
    return left_join_twice(
        od,
        li,
        [("o_orderkey", "l_orderkey"), ("o_orderstatus", "l_linestatus")],
        left_cols=od.columns,
        right_cols=["l_linenumber", "l_partkey"],
    )


# --------------------------------------------------------------- projections


def q_left_join_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A right side of few different rows, each many times: salted and expanded again."""
    li = _t(spark, sf_dir, "lineitem").select("l_linenumber", "l_returnflag")
    re = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return left_join(re, li, [("r_regionkey", "l_linenumber")], broadcast_rows=None, salt_rows=100)


def q_rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(
        _t(spark, sf_dir, "customer"),
        {
            "c_custkey": "skuIBGE",
            "C_NAME": "municipio",
            "c_nationkey": "uf",
            "c_mktsegment": "pais",
            "c_acctbal": "arrecadacao",
            "no_such_column": "ignored",
        },
    )


def q_project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_aliased(
        _t(spark, sf_dir, "supplier"),
        "s",
        {
            "s_suppkey": "s.s_suppkey",
            "s_name": "s.s_name",
            "s_nationkey": "s.s_nationkey",
            "nameCamel": title_case("s.s_name"),
        },
    )


def q_derive_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    sup = with_search_parameter(sup, PART_SEARCH)
    return with_columns(
        sup, {"search_phonetic": search_text(["s_suppkey", "s_name", "s_nationkey"])}
    )


def q_collect_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_city_record(part_as_workbook(_t(spark, sf_dir, "part")))


def q_collect_records_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: ten records on the driver, shown as a table again."""
    records = to_city_record(part_as_workbook(_t(spark, sf_dir, "part")))
    return spark.createDataFrame(collect_records(records, 10, ["linha"]), records.schema)


# --------------------------------------------------------------- aggregates, limits


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_t(spark, sf_dir, "lineitem"))


def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(_t(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"])


def q_city_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_preview(
        _t(spark, sf_dir, "part"), ["p_name", "p_brand", "p_type"], country_col="p_type"
    )


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return first_rows(cust, 10, ["c_custkey"])


def q_page_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return page_of_rows(od, page=2, size=10, order_by=["o_orderkey"])


def q_page_of_rows_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return page_of_rows(od, page=101, size=100, order_by=["o_orderkey"], topk_rows=0)


def q_distinct_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_distinct_rows(_t(spark, sf_dir, "part"), 10, ["p_name", "p_brand", "p_type"])


def _order_pages(spark: SparkSession, sf_dir: str):
    od = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return store_pages(od, scratch_path(spark, "order-pages"), ["o_orderpriority", "o_orderkey"], range_rows=1000)


def q_stored_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleventh page of 100 rows from a stored sort."""
    return stored_page(spark, _order_pages(spark, sf_dir), page=11, size=100)


def q_stored_page_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """250 rows from a given key on."""
    return rows_after(spark, _order_pages(spark, sf_dir), ("2-HIGH", 100), 250)


# --------------------------------------------------------------- text functions


def q_initcap_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _t(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        title_case("p_name").alias("name_title"),
        title_case("p_type").alias("type_title"),
        title_case("p_brand").alias("brand_title"),
    )


def q_search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(part_as_workbook(_t(spark, sf_dir, "part")))


def q_word_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_t(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return word_corpus(docs, cols=None, text_col="text", keep=["doc_id"])


# --------------------------------------------------------------- fuzzy search


def _doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id")
    return docs.select("doc_id", "lang", "source", explode_words("text").alias("palavras"))


def q_fuzzy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_filter(_doc_words(spark, sf_dir), DOC_SEARCH).select("doc_id", "palavras")


def q_fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_pairs(_doc_words(spark, sf_dir), DOC_SEARCH).select("doc_id", "palavras", "parameters")


THOUSAND_TERMS = " ".join(a + b + c for a in SYLLABLES for b in SYLLABLES for c in SYLLABLES)


def q_fuzzy_thousand_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_filter(_doc_words(spark, sf_dir), THOUSAND_TERMS).select("doc_id", "palavras")


def q_fuzzy_thousand_terms_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "doc-corpus")
    store_corpus(_doc_words(spark, sf_dir), path)
    return stored_fuzzy_filter(spark.read.parquet(path), THOUSAND_TERMS).select("doc_id", "palavras")


def _doc_index(spark: SparkSession, sf_dir: str) -> WordIndex:
    return build_word_index(_doc_words(spark, sf_dir), scratch_path(spark, "doc-index"), ["doc_id", "lang", "source"])


def q_fuzzy_documents_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a search from the words and postings of an inverted index."""
    return indexed_documents(spark, _doc_index(spark, sf_dir), DOC_SEARCH)


def q_fuzzy_thousand_terms_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand terms as a table, met by the deletion neighbourhoods of the indexed words."""
    terms = spark.range(1).select(F.explode(F.split(F.lit(THOUSAND_TERMS), " ")).alias("term"))
    return indexed_terms_filter(spark, _doc_index(spark, sf_dir), terms).select("doc_id", "palavras")


def q_fuzzy_search_table_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of searches against an inverted index."""
    searches = _t(spark, sf_dir, "region").select("r_regionkey", F.lower("r_name").alias("parameter"))
    found = indexed_fuzzy_join(spark, _doc_index(spark, sf_dir), searches)
    return found.select("doc_id", "palavras", "r_regionkey", "parameters")


def q_fuzzy_search_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches as data: a table of search texts against every word of every document."""
    searches = _t(spark, sf_dir, "region").select("r_regionkey", F.lower("r_name").alias("parameter"))
    found = fuzzy_join(_doc_words(spark, sf_dir), searches)
    return found.select("doc_id", "palavras", "r_regionkey", "parameters")


def q_fuzzy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fuzzy_filter(_doc_words(spark, sf_dir), DOC_SEARCH)
    return distinct_rows(found, ["doc_id", "lang", "source"])


def q_fuzzy_documents_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "doc-corpus")
    store_corpus(_doc_words(spark, sf_dir), path)
    found = stored_fuzzy_filter(spark.read.parquet(path), DOC_SEARCH)
    return distinct_rows(found, ["doc_id", "lang", "source"])


def _part_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_corpus(part_as_workbook(_t(spark, sf_dir, "part")))


def q_fuzzy_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_matches(_part_corpus(spark, sf_dir), PART_SEARCH)


def q_fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_search(_part_corpus(spark, sf_dir), PART_SEARCH)


# --------------------------------------------------------------- sound codes


def q_soundex_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a code depends on the word alone: de-duplicate words first, code after
    words = distinct_rows(_doc_words(spark, sf_dir).select("palavras"))
    return words.select(
        "palavras",
        soundex_code("palavras").alias("code"),
        phonetic_code("palavras").alias("phonetic"),
    )


def q_phonetic_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phonetic_filter(_doc_words(spark, sf_dir), SOUND_SEARCH)
    return distinct_rows(found, ["doc_id", "lang", "source"])


def q_phonetic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _doc_words(spark, sf_dir)
    return phonetic_pairs(words, SOUND_SEARCH).select("doc_id", "palavras", "parameters")


def q_phonetic_thousand_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and terms of equal sound, for a thousand terms."""
    words = distinct_rows(_doc_words(spark, sf_dir).select("palavras"))
    return phonetic_pairs(words, THOUSAND_TERMS).select("palavras", "parameters")


def q_phonetic_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phonetic_matches(_part_corpus(spark, sf_dir), PART_SOUND_SEARCH)


def q_sql_udf_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    register_view(_t(spark, sf_dir, "part"), "part_udf_view")
    return spark.sql(
        "SELECT p_partkey, soundex_udf(p_name) AS name_code, "
        "phonetic_code(p_type) AS type_code FROM part_udf_view"
    )


# --------------------------------------------------------------- sources, sinks


def q_sql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search as a table function over a registered corpus, called in SQL."""
    register_view(_doc_words(spark, sf_dir), "doc_words_view")
    register_search_function(spark, "doc_words_view", ["doc_id", "lang"])
    return spark.sql(f"SELECT doc_id, palavras FROM fuzzy_words('{DOC_SEARCH}') WHERE lang <> 'de'")


def _sound_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Words of the documents and of the parts' names as bucketed tables."""
    parts = _t(spark, sf_dir, "part").select(explode_words("p_name").alias("palavras"))
    names = []
    for label, words in (("docs", _doc_words(spark, sf_dir)), ("parts", parts)):
        path = scratch_path(spark, f"sound-{label}")
        names.append("sound_" + path.rsplit("-", 1)[1])
        store_sound_table(words, names[-1], path, buckets=16)
    return names[0], names[1]


def q_sound_pairs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents and of part names that sound alike, from tables bucketed by code."""
    return sound_pairs(spark, *_sound_tables(spark, sf_dir)).select("left_word", "left_n", "right_word")


def q_sound_search_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_like(spark, _sound_tables(spark, sf_dir)[0], SOUND_SEARCH).select("word", "n")


def q_view_select_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(_t(spark, sf_dir, "customer"), "cities_view")
    return read_view(spark, "cities_view")


def q_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines(_t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS))


def q_json_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "json-text")
    write_json_lines(_t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS), target)
    return spark.read.text(target)


def q_append_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "index")
    cities = _t(spark, sf_dir, "customer")
    append_to_index(cities, target, "parquet")
    append_to_index(cities, target, "parquet")
    return spark.read.parquet(target)


def q_csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "cities-csv")
    _t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS).write.option("header", True).csv(target)
    return read_csv_strings(spark, target)


# --------------------------------------------------------------- Excel, files


# Tasks that write the workbooks of a folder (a fixture: fixed, so that the
# number of workbooks is known and a lost one is noticed).
CUSTOMER_TASKS, SUPPLIER_TASKS = 4, 2


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS).repartition(CUSTOMER_TASKS, "c_custkey")


def _customer_workbooks(spark: SparkSession, sf_dir: str) -> str:
    """``customer`` (its whole-number and text columns) as workbooks in one
    folder, one per market segment and task."""
    folder = scratch_path(spark, "customer-xlsx")
    write_workbooks(_customers(spark, sf_dir), folder, split_by="c_mktsegment")
    return folder


def q_excel_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "customer-plain-xlsx")
    write_workbooks(_customers(spark, sf_dir), folder)
    schema = StructType([StructField(n, StringType(), True) for n in CUSTOMER_COLUMNS])
    return read_excel(spark, folder, schema)


def q_excel_scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_workbooks(spark, sf_dir)
    schema = StructType(
        [
            StructField("c_custkey", LongType(), True),
            StructField("c_name", StringType(), True),
            StructField("c_nationkey", IntegerType(), True),
            StructField("c_mktsegment", StringType(), True),
        ]
    )
    return read_excel(spark, f"{folder}/c_mktsegment=*.xlsx", schema)


def q_excel_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_excel(spark, f"{_customer_workbooks(spark, sf_dir)}/*.xlsx", infer=True)


def q_excel_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes to one folder: every row of both comes back."""
    folder = scratch_path(spark, "append-xlsx")
    write_workbooks(_customers(spark, sf_dir), folder)
    write_workbooks(_customers(spark, sf_dir), folder)
    schema = StructType([StructField(n, StringType(), True) for n in CUSTOMER_COLUMNS])
    return read_excel(spark, folder, schema)


def q_excel_late_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of numbers in some workbooks and words in others: text, nothing lost."""
    folder = scratch_path(spark, "late-xlsx")
    customers = _customers(spark, sf_dir)
    write_workbooks(customers.select(F.col("c_custkey").alias("v")), folder)
    write_workbooks(customers.select(F.col("c_name").alias("v")), folder)
    return read_excel(spark, folder, infer=True)


def q_excel_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks with and without a last column: the column is kept."""
    folder = scratch_path(spark, "drift-xlsx")
    customers = _customers(spark, sf_dir)
    write_workbooks(customers.select("c_custkey", "c_name"), folder)
    write_workbooks(customers.select("c_custkey", "c_name", "c_mktsegment"), folder)
    return read_excel(spark, folder, infer=True)


def q_excel_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row has no value at all: it stays a row."""
    folder = scratch_path(spark, "empty-xlsx")
    some = F.col("c_custkey") % 3 != 0
    rows = _customers(spark, sf_dir)
    write_workbooks(rows.select(F.when(some, F.col("c_custkey")).alias("k"), F.when(some, F.col("c_name")).alias("n")), folder)
    schema = StructType([StructField("k", LongType(), True), StructField("n", StringType(), True)])
    return read_excel(spark, folder, schema)


def q_excel_scan_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in one workbook, read by as many tasks as it has blocks."""
    folder = scratch_path(spark, "one-xlsx")
    write_workbooks(_t(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS).coalesce(1), folder)
    schema = StructType([StructField(n, StringType(), True) for n in CUSTOMER_COLUMNS])
    return read_workbook_blocks(spark, folder, schema, block_rows=1000)


def q_excel_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing folder: the second reads the new workbooks only, the third none."""
    folder, store = scratch_path(spark, "ingest-xlsx"), scratch_path(spark, "ingested")
    schema = StructType([StructField(n, StringType(), True) for n in CUSTOMER_COLUMNS])
    for part in (F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 3 != 0):
        write_workbooks(_customers(spark, sf_dir).where(part), folder)
        ingest_new(spark, folder, store, schema)
    ingest_new(spark, folder, store, schema)
    return ingested(spark, store, schema)


def q_file_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the headers of some workbooks depart from the commonest."""
    folder = _customer_workbooks(spark, sf_dir)
    first, second, *others = CUSTOMER_COLUMNS
    write_workbooks(_customers(spark, sf_dir).select(second, first, *others), folder)
    suppliers = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    write_workbooks(suppliers.repartition(SUPPLIER_TASKS, "s_suppkey"), folder)
    return drift_report(column_audit(spark, folder)).select("change", "column", "expected", "found").distinct()


def q_excel_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _customer_workbooks(spark, sf_dir))
    # one workbook per segment and task
    segment = F.regexp_extract("file", "^(.*)-part-[0-9]+", 1)
    return files.groupBy(segment.alias("file")).agg(F.countDistinct("file").alias("n"))


def q_file_column_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_workbooks(spark, sf_dir)
    suppliers = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    write_workbooks(suppliers.repartition(SUPPLIER_TASKS, "s_suppkey"), folder)
    name = F.regexp_extract("file", "^(.*)-part-[0-9]+", 1)
    label = F.when(name == "", F.lit("part")).otherwise(name)
    return column_audit(spark, folder).groupBy(label.alias("file"), "ordinal", "column").agg(F.countDistinct("file").alias("n"))


def _city_files(spark: SparkSession, sf_dir: str, times: int = 1) -> tuple[str, str]:
    """``customer`` as a municipalities workbook set and ``nation`` x ``region``
    (``times`` times over) as the states CSV; returns (workbook glob, CSV folder)."""
    nation, region = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    cust = left_join(_t(spark, sf_dir, "customer"), nation, [("c_nationkey", "n_nationkey")])
    known = {
        "skuIBGE": F.col("c_custkey").cast("string"),
        "siglaPais": F.col("n_regionkey").cast("string"),
        "type": F.col("c_mktsegment"),
        "municipio": F.col("c_name"),
        "pais": F.lower("c_mktsegment"),
        "uf": F.col("c_nationkey").cast("string"),
    }
    null = F.lit(None).cast("string")
    cities = cust.select(*[known.get(CITY_RENAMES[f.name], null).alias(f.name) for f in CITY_SCHEMA.fields])
    cities_dir = scratch_path(spark, "cities-xlsx")
    write_workbooks(cities.repartition(CUSTOMER_TASKS, cities.columns[0]), cities_dir)
    state = {
        "localCode": F.col("n_nationkey").cast("string"),
        "nomeEstado": F.col("n_name"),
        "continente": F.col("r_name"),
        "siglaPaisEstado": F.col("n_regionkey").cast("string"),
    }
    states = left_join(nation, region, [("n_regionkey", "r_regionkey")])
    states = states.select(*[state[new].alias(old) for old, new in STATE_RENAMES.items()])
    states_dir = scratch_path(spark, "states-csv")
    for _ in range(times):
        states.write.mode("append").option("header", True).csv(states_dir)
    return f"{cities_dir}/*.xlsx", states_dir


def q_enrich_from_files_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live path of the source application, on states that stand twice: 4 rows per city."""
    return enrich_from_files(spark, *_city_files(spark, sf_dir, times=2), twice=True)


def q_enrich_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_from_files(spark, *_city_files(spark, sf_dir))


def q_workbook_city_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = read_cities(spark, _city_files(spark, sf_dir)[0])
    return city_preview(cities, list(CITY_RENAMES.values()))


def q_enrich_and_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "city-index")
    enrich_and_index(spark, *_city_files(spark, sf_dir), target, "parquet")
    return spark.read.parquet(target)


def _part_workbooks(spark: SparkSession, sf_dir: str) -> str:
    """``part`` as country workbooks with the reference's headers, one per
    task (rebalanced only when ``part`` arrives in fewer splits than cores)."""
    wb = part_as_workbook(_t(spark, sf_dir, "part"))
    headers = [f.name for f in COUNTRY_SCHEMA.fields]
    folder = scratch_path(spark, "country-xlsx")
    write_workbooks(spread(wb.toDF(*headers), "linha"), folder)
    return f"{folder}/*.xlsx"


def q_workbook_search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(read_country_workbooks(spark, _part_workbooks(spark, sf_dir)))


def q_workbook_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "search-index")
    index_search_documents(spark, _part_workbooks(spark, sf_dir), target, "json")
    return spark.read.schema(SEARCH_DOC_SCHEMA).json(target)


def q_workbook_fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_country_workbooks(spark, _part_workbooks(spark, sf_dir))
    return fuzzy_search(word_corpus(table), PART_SEARCH)


def q_workbook_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_workbooks(spark, _part_workbooks(spark, sf_dir))[0]


def q_workbook_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_workbooks(spark, _part_workbooks(spark, sf_dir))[1]


QUERIES: dict[str, Query] = {
    "enrich_cities": q_enrich_cities,
    "enrich_cities_as_reference": q_enrich_cities_as_reference,
    "left_join_two_keys": q_left_join_two_keys,
    "left_join_twice": q_left_join_twice,
    "rename_columns": q_rename_columns,
    "project_alias": q_project_alias,
    "derive_constant": q_derive_constant,
    "collect_records": q_collect_records,
    "row_count": q_row_count,
    "distinct_rows": q_distinct_rows,
    "city_preview": q_city_preview,
    "preview_rows": q_preview_rows,
    "page_of_rows": q_page_of_rows,
    "page_of_rows_deep": q_page_of_rows_deep,
    "initcap_text": q_initcap_text,
    "search_text": q_search_text,
    "word_corpus": q_word_corpus,
    "fuzzy_filter": q_fuzzy_filter,
    "fuzzy_pairs": q_fuzzy_pairs,
    "fuzzy_documents": q_fuzzy_documents,
    "fuzzy_documents_stored": q_fuzzy_documents_stored,
    "fuzzy_matches": q_fuzzy_matches,
    "fuzzy_search": q_fuzzy_search,
    "soundex_codes": q_soundex_codes,
    "phonetic_match": q_phonetic_match,
    "phonetic_pairs": q_phonetic_pairs,
    "phonetic_matches": q_phonetic_matches,
    "sql_udf_call": q_sql_udf_call,
    "view_select_star": q_view_select_star,
    "json_lines": q_json_lines,
    "json_text_roundtrip": q_json_text_roundtrip,
    "append_sink_roundtrip": q_append_sink_roundtrip,
    "csv_scan_strings": q_csv_scan_strings,
    "excel_scan_schema": q_excel_scan_schema,
    "excel_scan_glob": q_excel_scan_glob,
    "excel_scan_inferred": q_excel_scan_inferred,
    "excel_list_files": q_excel_list_files,
    "file_column_audit": q_file_column_audit,
    "enrich_from_files": q_enrich_from_files,
    "enrich_and_index": q_enrich_and_index,
    "workbook_city_preview": q_workbook_city_preview,
    "workbook_search_documents": q_workbook_search_documents,
    "workbook_index": q_workbook_index,
    "workbook_fuzzy_search": q_workbook_fuzzy_search,
    "workbook_json_lines": q_workbook_json_lines,
    "workbook_row_count": q_workbook_row_count,
    "left_join_hot_key": q_left_join_hot_key,
    "fuzzy_thousand_terms": q_fuzzy_thousand_terms,
    "fuzzy_search_table": q_fuzzy_search_table,
    "collect_records_first": q_collect_records_first,
    "excel_append_twice": q_excel_append_twice,
    "excel_late_type": q_excel_late_type,
    "excel_drift": q_excel_drift,
    "excel_empty_rows": q_excel_empty_rows,
    "enrich_from_files_twice": q_enrich_from_files_twice,
    "distinct_first_rows": q_distinct_first_rows,
    "stored_page": q_stored_page,
    "stored_page_cursor": q_stored_page_cursor,
    "fuzzy_thousand_terms_stored": q_fuzzy_thousand_terms_stored,
    "fuzzy_documents_indexed": q_fuzzy_documents_indexed,
    "fuzzy_thousand_terms_indexed": q_fuzzy_thousand_terms_indexed,
    "fuzzy_search_table_indexed": q_fuzzy_search_table_indexed,
    "phonetic_thousand_pairs": q_phonetic_thousand_pairs,
    "sql_table_function": q_sql_table_function,
    "sound_pairs_bucketed": q_sound_pairs_bucketed,
    "sound_search_bucketed": q_sound_search_bucketed,
    "excel_scan_blocks": q_excel_scan_blocks,
    "excel_ingest": q_excel_ingest,
    "file_drift_report": q_file_drift_report,
}
