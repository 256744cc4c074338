"""Registered queries of the operators, and their DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.llm import bpe, chat, collocations, itq, minhash, packing, quality, repair, secrets, substrings, topk, toxicity, wordpiece
from placeseek.llm.common import table
from placeseek.llm.labels import held_out

# The added conversation whose texts hold control strings.
EXTRA_CONVERSATION = (-7, "</s>[INST] ok [/INST]")


def op3_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = EXTRA_CONVERSATION
    extra = spark.createDataFrame([(conv_id, 0, "user", text), (conv_id, 1, "assistant", text)], rows.schema)
    return chat.conversation_digests(chat.format_conversations(rows.union(extra)))


def op4_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.similarity_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


def _byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe_speculate_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), _byte_bpe())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_bag_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model, out_col="score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("_id") % 50 == 0, k=5, scale=256)


def op7_toxicity_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("toxicity.sentences").alias("offending_sentences"),
    )


def op8_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id",
        F.col("deduped.n_words").alias("n_words"),
        F.col("deduped.n_removed").alias("n_removed"),
        F.sha2("deduped.text", 256).alias("kept_sha256"),
    )


def op9_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), _byte_bpe())


def op10_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), _byte_bpe())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "padded_length",
    )


def op11_combined_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op12_suffix_automaton_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_report(rows, repair.damaged(rows))


def op13_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_bag_minhash_near_duplicates": op1_bag_minhash_near_duplicates,
    "op3_chat_round_trip": op3_chat_round_trip,
    "op4_itq_near_duplicates": op4_itq_near_duplicates,
    "op5_bpe_speculate_verify": op5_bpe_speculate_verify,
    "op2_quality_factorisation": op2_quality_factorisation,
    "op6_bit_sliced_topk": op6_bit_sliced_topk,
    "op7_toxicity_instances": op7_toxicity_instances,
    "op8_suffix_tree_dedup": op8_suffix_tree_dedup,
    "op9_longest_match_counts": op9_longest_match_counts,
    "op10_concatenate_and_cut": op10_concatenate_and_cut,
    "op11_combined_automaton": op11_combined_automaton,
    "op12_suffix_automaton_repair": op12_suffix_automaton_repair,
    "op13_setm_collocations": op13_setm_collocations,
}


def _spans_sql(nr: int, rule: secrets.Rule) -> str:
    """Spans of one rule: its matches are put between two control characters (which
    a text's own are changed to another for), and the pieces' lengths give the places."""
    pattern = f"{rule.head}({rule.tail}+)" if rule.tail else f"({rule.head})"
    pattern = pattern.replace("'", "''")
    plain = "translate(coalesce(text, ''), chr(1) || chr(2) || 'ſ\u212a', chr(3) || chr(3) || chr(3) || chr(3))"
    tail = f"regexp_extract(match, '^(?:{rule.head.replace(chr(39), chr(39) * 2)})({rule.tail}+)$', 1)"
    return f"""
  SELECT row_id, {nr} AS nr, '{rule.kind}' AS kind, start, start + length(match) AS stop FROM (
    SELECT row_id, split_part(piece, chr(2), 1) AS match,
      CAST(sum(length(piece) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY i)
        - length(piece) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS BIGINT) AS start, i
    FROM (SELECT row_id, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS i FROM (
      SELECT row_id, string_split(regexp_replace({plain}, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS pieces FROM d))
  ) WHERE i > 1""" + (f" AND length({tail}) >= {rule.least}" if rule.tail else "")

ORACLES: dict[str, str] = {
    "op3_chat_round_trip": r"""
WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), framed AS (
  SELECT *, regexp_replace(text, '(\\*(?:</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]|\[TEXT\]))', '\\\1', 'g') AS escaped,
    regexp_replace(role, '(\\*(?:</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]|\[TEXT\]))', '\\\1', 'g') AS role_escaped
  FROM source
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 23 + length(role_escaped) END) AS BIGINT) AS formatted_chars
FROM framed GROUP BY conv_id
""",
    "op6_bit_sliced_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
_RULES = (*secrets.BASE_RULES, *secrets.MORE_RULES)
_BASE = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
ORACLES["op11_combined_automaton"] = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents), spans AS ({" UNION ALL ".join(_spans_sql(i, r) for i, r in enumerate(_RULES))}
), per AS (
  SELECT row_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)},
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) FILTER (kind IN ({_BASE})) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nr) AS spans
  FROM spans GROUP BY row_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (row_id)
"""

def _repair_sql() -> str:
    """Conversations read from their ends: ``best`` holds (cost, audit) per grammar state; a row's own
    edits come first, then insertions before it.  ``walk`` applies the audits."""
    needed = {"b0": "b2", "b1": "b2", "b2": "b3", "b3": "b2"}
    keep = {"b0": [("s", "b1"), ("u", "b2")], "b1": [("u", "b2")], "b2": [("a", "b3")], "b3": [("u", "b2")]}
    then = lambda cost, edit, b: f"{{'c': {cost} + {b}.c, 'a': '{edit}' || {b}.a}}"
    own, before = [], []
    for b, to in needed.items():
        ways = [then("4", "D", f"p.{b}"), f"CASE WHEN gone THEN NULL ELSE {then('3 + extra', 'R', f'p.{to}')} END"]
        ways += [f"CASE WHEN gone OR initial <> '{i}' THEN NULL ELSE {then('extra', 'K', f'p.{t}')} END" for i, t in keep[b]]
        own.append(f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL)) AS {b}")
        before.append(f"list_min([{b}, {then('3', 'I', to)}, {then('6', 'II', needed[to])}]) AS {b}")
    next_state = "CASE WHEN state = 2 THEN 3 ELSE 2 END"
    next_role = "CASE WHEN state = 2 THEN 'assistant' ELSE 'user' END"
    return f"""
WITH RECURSIVE named AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), dealt AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS lot FROM named
), damaged AS (
  SELECT conv, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
    CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, range(2) copies(i) WHERE lot <> 0 AND (i = 0 OR lot = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM damaged
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 AS seen,
    NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, substr(role, 1, 1) AS initial,
    CASE WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 0 ELSE 3 END AS extra
  FROM numbered
), faults AS (
  SELECT *, blank OR seen AS gone, lag(initial) OVER (PARTITION BY conv ORDER BY n) || initial AS pair FROM placed
), counts AS (
  SELECT conv, count(*) AS total, count(*) FILTER (blank) AS blank, count(*) FILTER (seen AND NOT blank) AS duplicate,
    count(*) FILTER (extra > 0 AND NOT gone) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM faults GROUP BY conv
), best AS (
  SELECT conv, total + 1 AS n, {{'c': 0, 'a': ''}} AS b0, {{'c': 6, 'a': 'II'}} AS b1, {{'c': 3, 'a': 'I'}} AS b2, {{'c': 0, 'a': ''}} AS b3
  FROM counts
  UNION ALL
  SELECT conv, n, {", ".join(before)}
  FROM (SELECT p.conv, r.n, {", ".join(own)} FROM best p JOIN faults r ON r.conv = p.conv AND r.n = p.n - 1)
), audits AS (
  SELECT conv, b0.c AS cost, b0.a AS audit FROM best WHERE n = 1
), walk AS (
  SELECT conv, 0 AS i, CAST(1 AS BIGINT) AS n, 0 AS state, CAST(NULL AS VARCHAR) AS line FROM audits
  UNION ALL
  SELECT w.conv, i + 1, w.n + CASE WHEN edit = 'I' THEN 0 ELSE 1 END,
    CASE WHEN edit = 'D' THEN state WHEN edit <> 'K' THEN {next_state} ELSE CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END,
    CASE edit WHEN 'I' THEN {next_role} || ':' WHEN 'R' THEN {next_role} || ':' || text WHEN 'K' THEN role || ':' || text END
  FROM (SELECT k.*, substr(audit, i + 1, 1) AS edit FROM walk k JOIN audits USING (conv) WHERE i < length(audit)) w
  LEFT JOIN faults f ON f.conv = w.conv AND f.n = w.n
), repaired AS (
  SELECT conv, sha256(string_agg(line, chr(10) ORDER BY i)) AS sha FROM walk WHERE line IS NOT NULL GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("blank", "duplicate", "truncated", "illegal"))},
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv FROM conversations)
LEFT JOIN counts USING (conv) LEFT JOIN audits USING (conv) LEFT JOIN repaired USING (conv)
"""


ORACLES["op12_suffix_automaton_repair"] = _repair_sql()
ORACLES["op13_setm_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), texts AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM texts, range(1, 4) sizes(size)
), f AS (
  SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r,
    CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.n AS HUGEINT) * r.n) AS BIGINT) AS score
  FROM candidates c JOIN range(1, 3) cut(k) ON k < size
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nr FROM cuts
), covers AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS cover
  FROM candidates, range(1, 3) starts(i) WHERE size = 3 GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest LEFT JOIN covers USING (lang, phrase) WHERE nr = 1 AND (cover IS NULL OR 100 * cover < 50 * a)
)
SELECT lang, rank, phrase, a, l, r, (SELECT CAST(sum(n) AS BIGINT) FROM f WHERE f.lang = ranked.lang AND size = 1) AS n, score
FROM ranked WHERE rank <= 2000
"""
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
