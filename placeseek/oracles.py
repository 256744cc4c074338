"""Independent DuckDB formulations of the registered queries.

Written in plain SQL from the query's meaning, not from the Spark code.
DuckDB has neither ``initcap`` nor ``soundex`` and measures edit distance
in bytes, so three small SQL recipes stand in for them (below).
"""

from __future__ import annotations

# Java's \s (ASCII blanks) as an RE2 class; DuckDB's own \s
# lacks the vertical tab.
WS = r"[ \t\n\x0B\f\r]+"

# The non-ASCII letters of the driver's documents.  The edit
# distance recipe maps each to a one-byte control character that the texts
# do not contain, so DuckDB's byte distance equals Spark's character one.
DOC_NON_ASCII = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_PLACEHOLDERS = [*range(1, 9), *range(14, 27)]


def _one_byte(expr: str) -> str:
    to = " || ".join(f"chr({i})" for i in _PLACEHOLDERS[: len(DOC_NON_ASCII)])
    return f"translate({expr}, '{DOC_NON_ASCII}', {to})"


def sql_distance_below(a: str, b: str, limit: int = 3) -> str:
    return f"levenshtein({_one_byte(a)}, {_one_byte(b)}) < {limit}"


def sql_initcap(expr: str) -> str:
    """Lower-case, split on the space, upper-case each part's first letter."""
    return (
        f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
        f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


def sql_soundex(expr: str) -> str:
    """American Soundex of the ASCII letters of ``expr`` ('' when none)."""
    u = f"upper(regexp_replace({expr}, '[^A-Za-z]', '', 'g'))"
    d = f"translate({u}, 'AEIOUYBFPVCGJKQSXZDTLMNRHW', '00000011112222222233455677')"
    # H and W are skipped (kept only in first place), then runs collapse
    d = f"(substr({d}, 1, 1) || replace(substr({d}, 2), '7', ''))"
    for digit in "0123456":
        d = f"regexp_replace({d}, '{digit}+', '{digit}', 'g')"
    rest = f"rpad(substr(replace(substr({d}, 2), '0', ''), 1, 3), 3, '0')"
    return f"(CASE WHEN {u} = '' THEN '' ELSE substr({u}, 1, 1) || {rest} END)"


def _words(cols: str) -> str:
    return f"SELECT {cols}, unnest(regexp_split_to_array(text, '{WS}')) AS palavras FROM documents"


def _terms(text: str) -> str:
    return f"SELECT unnest(regexp_split_to_array('{text}', '{WS}')) AS term"


_PART_WB = (
    "SELECT CAST(p_partkey AS INTEGER) AS linha, p_name AS municipio, p_type AS tipo, "
    "p_brand AS h, CAST(p_size AS VARCHAR) AS cep, CAST(NULL AS VARCHAR) AS sku_pais, "
    "CAST(p_partkey AS VARCHAR) AS sku_municipio FROM part"
)
_PART_TEXT = "concat_ws(' ', linha, municipio, tipo, h, cep, sku_pais, sku_municipio)"
_PART_CORPUS = (
    f"SELECT *, unnest(regexp_split_to_array({_PART_TEXT}, '{WS}')) AS palavras "
    f"FROM ({_PART_WB})"
)
_PART_MATCHES = (
    f"SELECT DISTINCT linha, municipio, tipo, h, cep, sku_pais, sku_municipio "
    f"FROM ({_PART_CORPUS}) w WHERE EXISTS (SELECT 1 FROM ({_terms('smal rng')}) t "
    f"WHERE {sql_distance_below('w.palavras', 't.term')})"
)

_SEGMENT_FILES = "SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS file, 4 AS n FROM customer"
_CUSTOMER_TEXT = (
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
    "CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer"
)
_PART_WB_FILES = (
    "SELECT linha, municipio, tipo, h, cep, '' AS sku_pais, sku_municipio FROM (" + _PART_WB + ")"
)
_PART_FILES_MATCHES = _PART_MATCHES.replace(_PART_WB, _PART_WB_FILES)


def _columns_of(table: str, leave_out: str) -> str:
    """Header names of ``table`` written without column ``leave_out``, numbered from 0."""
    return (
        "SELECT CAST(row_number() OVER (ORDER BY ordinal_position) - 1 AS INTEGER) AS ordinal, "
        "column_name AS \"column\" FROM information_schema.columns "
        f"WHERE table_name = '{table}' AND column_name <> '{leave_out}'"
    )


ORACLES: dict[str, str] = {
    "enrich_cities": (
        "SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, "
        f"{sql_initcap('c.c_mktsegment')} AS paisCamel, s.nomeEstado, s.continente "
        "FROM customer c LEFT JOIN (SELECT n.n_nationkey, n.n_name AS nomeEstado, "
        "r.r_name AS continente FROM nation n LEFT JOIN region r "
        "ON n.n_regionkey = r.r_regionkey) s ON c.c_nationkey = s.n_nationkey"
    ),
    "enrich_cities_as_reference": (
        "SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, "
        f"{sql_initcap('c.c_mktsegment')} AS paisCamel, s.nomeEstado, s.continente "
        "FROM (SELECT * FROM customer cu LEFT JOIN (SELECT n_nationkey, n_name AS nomeEstado, "
        "r_name AS continente FROM nation JOIN region ON n_regionkey = r_regionkey) s1 "
        "ON cu.c_nationkey = s1.n_nationkey) c "
        "LEFT JOIN (SELECT n_nationkey, n_name AS nomeEstado, r_name AS continente "
        "FROM nation JOIN region ON n_regionkey = r_regionkey) s ON c.c_nationkey = s.n_nationkey"
    ),
    "left_join_two_keys": (
        "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_linestatus, "
        "o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority "
        "FROM lineitem l LEFT JOIN orders o "
        "ON l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus"
    ),
    "left_join_twice": (
        "SELECT c.o_orderkey, c.o_custkey, c.o_orderstatus, c.o_orderpriority, "
        "s.l_linenumber, s.l_partkey FROM (SELECT * FROM orders o LEFT JOIN lineitem l "
        "ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = l.l_linestatus) c "
        "LEFT JOIN lineitem s ON c.o_orderkey = s.l_orderkey AND c.o_orderstatus = s.l_linestatus"
    ),
    "rename_columns": (
        "SELECT c_custkey AS skuIBGE, c_name AS municipio, c_nationkey AS uf, "
        "c_acctbal AS arrecadacao, c_mktsegment AS pais FROM customer"
    ),
    "project_alias": (
        "SELECT s.s_suppkey, s.s_name, s.s_nationkey, "
        f"{sql_initcap('s.s_name')} AS nameCamel FROM supplier AS s"
    ),
    "derive_constant": (
        "SELECT s_suppkey, s_name, s_nationkey, 'smal rng' AS parameter, "
        "concat_ws(' ', s_suppkey, s_name, s_nationkey) AS search_phonetic FROM supplier"
    ),
    "collect_records": (
        "SELECT linha, municipio AS municipios, tipo, h, cep, sku_pais AS paisSKU, "
        f"sku_municipio AS municipioSKU FROM ({_PART_WB})"
    ),
    "row_count": "SELECT count(*) AS n FROM lineitem",
    "distinct_rows": "SELECT DISTINCT p_name, p_brand, p_type FROM part",
    "city_preview": (
        f"SELECT DISTINCT p_name, p_brand, p_type, {sql_initcap('p_type')} AS paisCamel "
        "FROM part ORDER BY 1, 2, 3, 4 LIMIT 10"
    ),
    "preview_rows": (
        "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer "
        "ORDER BY c_custkey LIMIT 10"
    ),
    "page_of_rows": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders "
        "ORDER BY o_orderkey LIMIT 10 OFFSET 10"
    ),
    "page_of_rows_deep": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders "
        "ORDER BY o_orderkey LIMIT 100 OFFSET 10000"
    ),
    "initcap_text": (
        f"SELECT p_partkey, {sql_initcap('p_name')} AS name_title, "
        f"{sql_initcap('p_type')} AS type_title, {sql_initcap('p_brand')} AS brand_title FROM part"
    ),
    "search_text": (
        "SELECT linha, municipio, tipo, h, cep, sku_pais AS skuPais, "
        f"sku_municipio AS skuMunicipio, {_PART_TEXT} AS search_phonetic FROM ({_PART_WB})"
    ),
    "word_corpus": _words("doc_id"),
    "fuzzy_filter": (
        f"SELECT w.doc_id, w.palavras FROM ({_words('doc_id')}) w "
        f"WHERE EXISTS (SELECT 1 FROM ({_terms('erblest therouou')}) t "
        f"WHERE {sql_distance_below('w.palavras', 't.term')})"
    ),
    "fuzzy_pairs": (
        f"SELECT w.doc_id, w.palavras, t.term AS parameters FROM ({_words('doc_id')}) w "
        f"JOIN ({_terms('erblest therouou')}) t ON {sql_distance_below('w.palavras', 't.term')}"
    ),
    "fuzzy_documents": (
        f"SELECT DISTINCT w.doc_id, w.lang, w.source FROM ({_words('doc_id, lang, source')}) w "
        f"WHERE EXISTS (SELECT 1 FROM ({_terms('erblest therouou')}) t "
        f"WHERE {sql_distance_below('w.palavras', 't.term')})"
    ),
    "fuzzy_matches": _PART_MATCHES,
    "fuzzy_search": (
        "SELECT linha, municipio AS municipios, tipo, h, cep, sku_pais AS paisSKU, "
        f"sku_municipio AS municipioSKU FROM ({_PART_MATCHES}) "
        "ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST, "
        "5 NULLS FIRST, 6 NULLS FIRST, 7 NULLS FIRST LIMIT 10"
    ),
    "soundex_codes": (
        f"SELECT DISTINCT palavras, {sql_soundex('palavras')} AS code, "
        f"{sql_soundex('lower(palavras)')} AS phonetic FROM ({_words('doc_id')})"
    ),
    "phonetic_match": (
        f"SELECT DISTINCT w.doc_id, w.lang, w.source FROM ({_words('doc_id, lang, source')}) w "
        f"WHERE {sql_soundex('w.palavras')} <> '' AND {sql_soundex('w.palavras')} IN "
        f"(SELECT {sql_soundex('term')} FROM ({_terms('erblest therouou')}))"
    ),
    "phonetic_matches": (
        f"SELECT DISTINCT linha, municipio, tipo, h, cep, sku_pais, sku_municipio FROM ({_PART_CORPUS}) w "
        f"WHERE {sql_soundex('w.palavras')} IN (SELECT {sql_soundex('term')} FROM ({_terms('smol rinj')}) "
        f"WHERE {sql_soundex('term')} <> '')"
    ),
    "phonetic_pairs": (
        f"SELECT w.doc_id, w.palavras, t.term AS parameters FROM ({_words('doc_id')}) w "
        f"JOIN ({_terms('erblest therouou')}) t ON {sql_soundex('w.palavras')} = {sql_soundex('t.term')} "
        f"AND {sql_soundex('t.term')} <> ''"
    ),
    "sql_udf_call": (
        f"SELECT p_partkey, {sql_soundex('p_name')} AS name_code, "
        f"{sql_soundex('lower(p_type)')} AS type_code FROM part"
    ),
    "view_select_star": "SELECT * FROM customer",
    "json_lines": (
        "SELECT to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, "
        "'c_mktsegment': c_mktsegment})::VARCHAR AS value FROM customer"
    ),
    "append_sink_roundtrip": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "excel_scan_schema": _CUSTOMER_TEXT,
    "excel_scan_glob": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "excel_scan_inferred": (
        "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, "
        "CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_mktsegment FROM customer"
    ),
    "excel_list_files": _SEGMENT_FILES,
    "file_column_audit": (
        f"SELECT f.file, c.ordinal, c.\"column\", f.n FROM ({_SEGMENT_FILES}) f, "
        f"({_columns_of('customer', 'c_acctbal')}) c "
        f"UNION ALL SELECT 'part' AS file, c.ordinal, c.\"column\", 2 AS n FROM ({_columns_of('supplier', 's_acctbal')}) c"
    ),
    "enrich_from_files": (
        "SELECT CAST(c.c_custkey AS VARCHAR) AS skuIBGE, CAST(n.n_regionkey AS VARCHAR) AS siglaPais, "
        "c.c_mktsegment AS type, '' AS ordemAlfabetica, '' AS skuFeriaz, c.c_name AS municipio, "
        "lower(c.c_mktsegment) AS pais, '' AS regiao, CAST(c.c_nationkey AS VARCHAR) AS uf, "
        "'' AS regiaoTuristica, '' AS arrecadacao, '' AS cluster, "
        f"{sql_initcap('c.c_mktsegment')} AS paisCamel, s.n_name AS nomeEstado, s.r_name AS continente "
        "FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
        "LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) s "
        "ON CAST(n.n_regionkey AS VARCHAR) = CAST(s.n_regionkey AS VARCHAR) "
        "AND CAST(c.c_nationkey AS VARCHAR) = CAST(s.n_nationkey AS VARCHAR)"
    ),
    "workbook_search_documents": (
        "SELECT linha, municipio, tipo, h, cep, sku_pais AS skuPais, "
        f"sku_municipio AS skuMunicipio, {_PART_TEXT} AS search_phonetic FROM ({_PART_WB_FILES})"
    ),
    "workbook_fuzzy_search": (
        "SELECT linha, municipio AS municipios, tipo, h, cep, sku_pais AS paisSKU, "
        f"sku_municipio AS municipioSKU FROM ({_PART_FILES_MATCHES}) "
        "ORDER BY 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST, "
        "5 NULLS FIRST, 6 NULLS FIRST, 7 NULLS FIRST LIMIT 10"
    ),
    "workbook_json_lines": (
        "SELECT to_json({'linha': linha, 'Municípios': municipio, 'Tipo': tipo, 'H': h, "
        "'CEP': cep, 'SKU País': sku_pais, 'SKU Município': sku_municipio})::VARCHAR AS value "
        f"FROM ({_PART_WB_FILES})"
    ),
    "workbook_row_count": "SELECT count(*) AS n FROM part",
    "csv_scan_strings": _CUSTOMER_TEXT,
}
ORACLES["enrich_and_index"] = ORACLES["enrich_from_files"]
ORACLES["workbook_index"] = ORACLES["workbook_search_documents"]
ORACLES["fuzzy_documents_stored"] = ORACLES["fuzzy_documents"]
ORACLES["workbook_city_preview"] = (
    "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS skuIBGE, CAST(n_regionkey AS VARCHAR) AS siglaPais, "
    "c_mktsegment AS type, '' AS ordemAlfabetica, '' AS skuFeriaz, c_name AS municipio, "
    "lower(c_mktsegment) AS pais, '' AS regiao, CAST(c_nationkey AS VARCHAR) AS uf, "
    "'' AS regiaoTuristica, '' AS arrecadacao, '' AS cluster, "
    f"{sql_initcap('c_mktsegment')} AS paisCamel "
    "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
    "ORDER BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13 LIMIT 10"
)
ORACLES["json_text_roundtrip"] = ORACLES["json_lines"]
ORACLES["left_join_hot_key"] = (
    "SELECT r_regionkey, r_name, l_linenumber, l_returnflag FROM region LEFT JOIN lineitem ON r_regionkey = l_linenumber"
)
_SYLLABLES = "(SELECT unnest(['the', 'an', 'er', 'ing', 'tion', 'ea', 'ou', 'st', 'nd', 'wh']) AS s)"
_THOUSAND = f"SELECT a.s || b.s || c.s AS term FROM {_SYLLABLES} a, {_SYLLABLES} b, {_SYLLABLES} c"
# distinct words in one-byte form first, and a length test before the distance
ORACLES["fuzzy_thousand_terms"] = (
    f"WITH w AS ({_words('doc_id')}), d AS (SELECT palavras, {_one_byte('palavras')} AS b FROM (SELECT DISTINCT palavras FROM w)), "
    f"found AS (SELECT DISTINCT d.palavras FROM d JOIN ({_THOUSAND}) t "
    "ON abs(length(d.b) - length(t.term)) < 3 AND levenshtein(d.b, t.term) < 3) "
    "SELECT w.doc_id, w.palavras FROM w JOIN found USING (palavras)"
)
ORACLES["fuzzy_search_table"] = (
    "SELECT w.doc_id, w.palavras, t.r_regionkey, t.parameters FROM "
    f"({_words('doc_id')}) w JOIN (SELECT r_regionkey, unnest(string_split_regex(lower(r_name), '\\s+')) AS parameters "
    f"FROM region) t ON {sql_distance_below('w.palavras', 't.parameters')}"
)
ORACLES["collect_records_first"] = f"SELECT * FROM ({ORACLES['collect_records']}) ORDER BY linha LIMIT 10"
ORACLES["excel_append_twice"] = f"{_CUSTOMER_TEXT} UNION ALL {_CUSTOMER_TEXT}"
ORACLES["excel_late_type"] = "SELECT CAST(c_custkey AS VARCHAR) AS v FROM customer UNION ALL SELECT c_name FROM customer"
ORACLES["excel_drift"] = (
    "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, '' AS c_mktsegment FROM customer "
    "UNION ALL SELECT CAST(c_custkey AS DOUBLE), c_name, c_mktsegment FROM customer"
)
ORACLES["excel_empty_rows"] = (
    "SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, "
    "CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE '' END AS n FROM customer"
)
ORACLES["enrich_from_files_twice"] = f"SELECT e.* FROM ({ORACLES['enrich_from_files']}) e, range(4)"
ORACLES["distinct_first_rows"] = f"{ORACLES['distinct_rows']} ORDER BY 1, 2, 3 LIMIT 10"
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"
ORACLES["stored_page"] = f"{_ORDERS} ORDER BY o_orderpriority, o_orderkey LIMIT 100 OFFSET 1000"
ORACLES["stored_page_cursor"] = (
    f"{_ORDERS} WHERE (o_orderpriority, o_orderkey) > ('2-HIGH', 100) ORDER BY o_orderpriority, o_orderkey LIMIT 250"
)
ORACLES["fuzzy_thousand_terms_stored"] = ORACLES["fuzzy_thousand_terms_indexed"] = ORACLES["fuzzy_thousand_terms"]
ORACLES["fuzzy_documents_indexed"] = ORACLES["fuzzy_documents"]
ORACLES["fuzzy_search_table_indexed"] = ORACLES["fuzzy_search_table"]
ORACLES["phonetic_thousand_pairs"] = (
    f"WITH w AS (SELECT palavras, {sql_soundex('palavras')} AS code FROM (SELECT DISTINCT palavras FROM ({_words('doc_id')}))), "
    f"t AS (SELECT term, {sql_soundex('term')} AS code FROM ({_THOUSAND})) "
    "SELECT palavras, term AS parameters FROM w JOIN t ON w.code = t.code WHERE w.code <> ''"
)
ORACLES["sql_table_function"] = (
    f"SELECT w.doc_id, w.palavras FROM ({_words('doc_id, lang')}) w WHERE w.lang <> 'de' "
    f"AND EXISTS (SELECT 1 FROM ({_terms('erblest therouou')}) t WHERE {sql_distance_below('w.palavras', 't.term')})"
)
_CODED_WORDS = f"SELECT palavras, count(*) AS n, {sql_soundex('palavras')} AS code FROM ({_words('doc_id')}) GROUP BY palavras"
_CODED_NAMES = f"SELECT word, {sql_soundex('word')} AS code FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)"
ORACLES["sound_pairs_bucketed"] = (
    f"SELECT a.palavras AS left_word, a.n AS left_n, b.word AS right_word FROM ({_CODED_WORDS}) a JOIN ({_CODED_NAMES}) b "
    "ON a.code = b.code WHERE a.code <> ''"
)
ORACLES["sound_search_bucketed"] = (
    f"SELECT palavras AS word, n FROM ({_CODED_WORDS}) WHERE code <> '' AND code IN "
    f"(SELECT {sql_soundex('term')} FROM ({_terms('erblest therouou')}))"
)
ORACLES["excel_scan_blocks"] = ORACLES["excel_ingest"] = _CUSTOMER_TEXT
_CUSTOMER_HEADER, _SUPPLIER_HEADER = _columns_of("customer", "c_acctbal"), _columns_of("supplier", "s_acctbal")
ORACLES["file_drift_report"] = (
    f"SELECT 'missing' AS change, \"column\", ordinal AS expected, CAST(NULL AS INTEGER) AS found FROM ({_CUSTOMER_HEADER}) "
    f"UNION ALL SELECT 'inserted', \"column\", NULL, ordinal FROM ({_SUPPLIER_HEADER}) "
    f"UNION ALL SELECT 'moved', \"column\", ordinal, 1 - ordinal FROM ({_CUSTOMER_HEADER}) WHERE ordinal < 2"
)
