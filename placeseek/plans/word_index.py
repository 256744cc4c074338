"""A stored inverted index of a word corpus (PIPE5, JON3, PIPE6).

The source application tests every occurrence of every word in each search.  Here a
corpus is indexed once, under one folder:

* ``words``: each distinct word with an id, its length and the number of rows it has,
  sorted by length, so a search reads the row groups of its length band only;
* ``postings``: per word, blocks of ``POSTING_ROWS`` of the rows that hold it.  The rows of a word that is in
  every row are dealt to many tasks by a hash, so it has many blocks of the usual size;
* ``neighbours``: per beginning of a word (its head) the hashes of what is left of it after up to ``edits``
  deletions.  Two words within ``edits`` edits have such a rest in common, so a table of terms meets the words in
  an equi-join, and no term is tested against a word that shares nothing with it.  Words with one head have
  the same rests, which are kept once; keys and heads are hashes of 32 bits, as the distance is tested on what meets.

``postings`` and ``neighbours`` are partitioned into folders by a hash of what they are looked up
by: a search reads the folders of what it found, and the corpus itself is not read.

A word's id is a hash of it (with a seed found to give no two words the same), so rows and
neighbours are dealt to their folders without a join or a sort of all of them.

Building takes disk for a share of the rows at a time: they are written once, unshuffled, into ``DEALS`` folders,
shuffled to their postings by rounds of these, and what a step has shuffled is dropped when it has written.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions.distance import PREFIX, deletions, near_any
from placeseek.functions.text import explode_words, split_terms
from placeseek.operators.joins import BROADCAST_BYTES, expand, is_small
from placeseek.operators.search import DISTANCE_LIMIT, length_bands
from placeseek.plans.search import WORD_COL
from placeseek.session import SHUFFLES_DROPPED, fits_for_broadcast, removed, scratch_path, session_conf, stored

#: Rows of one posting block (on average), and folders of the postings and neighbours.
POSTING_ROWS = 4096
INDEX_PARTS = 64
#: Rows of one file of a folder (on average), and blocks of one word that go to the same file.
FILE_ROWS = 2_000_000
FILE_BLOCKS = 64
#: Folders that the rows are written into first, words of one folder together, and rows that one round shuffles
#: (the folders are the most rounds there are).
DEALS = 8
ROUND_ROWS = 8_000_000
#: Neighbours that one task makes (on average); each task writes a file in every folder.
NEAR_ROWS = 4_000_000
#: With this setting, a task that writes to fewer folders does so without sorting its rows.
FOLDERS_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"
#: What the index and the rows on their way to it are written with.
PACKED = {"compression": "zstd", "parquet.dictionary.page.size": 8 * 1024 * 1024}
#: Words, or neighbours of terms, that one search may broadcast.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class WordIndex:
    """An index stored at ``path``: ``keys`` are the columns a posting carries, ``edits`` the
    distance its neighbours serve."""

    path: str
    keys: tuple[str, ...]
    key_types: tuple[str, ...]
    edits: int = DISTANCE_LIMIT - 1
    parts: int = INDEX_PARTS

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        columns = ", ".join(f"`{k}`: {t}" for k, t in zip(self.keys, self.key_types))
        schema = {
            "words": "word string, n long, wlen int, word_id long",
            "postings": f"word_id long, block long, entries array<struct<{columns}, times: long>>, part int",
            "neighbours": "key int, head int, part int",
        }[name]
        return spark.read.schema(schema).parquet(f"{self.path}/{name}")


def _head(word: Column) -> Column:
    """What stands for the beginning that the neighbours of ``word`` come from."""
    return F.hash(F.substring(word, 1, PREFIX))


def build_word_index(
    corpus: DataFrame, path: str, keys: Sequence[str], word_col: str = WORD_COL, edits: int = DISTANCE_LIMIT - 1,
    parts: int = INDEX_PARTS, posting_rows: int = POSTING_ROWS,
) -> WordIndex:
    """Index ``corpus`` (one row per word) under ``path``; null words are left out, as they match nothing.

    A row that holds a word several times is one posting with its number of times.
    """
    spark = corpus.sparkSession
    types = tuple(corpus.select(k).schema[0].dataType.simpleString() for k in keys)
    index = WordIndex(path, tuple(keys), types, edits, parts)
    scratch = {name: scratch_path(spark, name) for name in ("word-rows", "word-counts", "word-heads")}
    with session_conf(spark, {SHUFFLES_DROPPED: "true"}):
        columns = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
        rows = corpus.where(F.col(word_col).isNotNull()).select(F.col(word_col).alias("word"), *columns)
        deal = F.floor(_part(_word_id(F.col("word"), 0), parts) * DEALS / parts).cast("int")
        rows = rows.withColumn("_deal", deal)
        with session_conf(spark, {FOLDERS_AT_ONCE: str(DEALS + 1)}):
            rows.write.options(**PACKED).partitionBy("_deal").parquet(scratch["word-rows"])
        rows = _read(spark, rows, scratch["word-rows"])

        counts = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        counts.write.options(**PACKED).parquet(scratch["word-counts"])
        counts = _read(spark, counts, scratch["word-counts"])
        seed, n_rows = _free_seed(counts)
        words = counts.withColumn("word_id", _word_id(F.col("word"), seed))

        # a row has its word's id without a join; only words of several blocks are looked up
        hot = words.where(F.col("n") > posting_rows).select("word_id", F.ceil(F.col("n") / posting_rows).alias("_blocks"))
        if is_small(hot, BROADCAST_ROWS):
            hot = F.broadcast(hot)
        files = -(-n_rows // (parts * FILE_ROWS)) or 1
        rounds = min(DEALS, -(-n_rows // ROUND_ROWS) or 1)
        for i in range(rounds):
            deals = range(i * DEALS // rounds, (i + 1) * DEALS // rounds)
            some = rows.where(F.col("_deal").between(deals[0], deals[-1]))
            listed = some.withColumn("word_id", _word_id(F.col("word"), seed)).drop("word", "_deal").join(hot, "word_id", "left")
            _write_postings(listed, index, files, posting_rows, more=i > 0)
            if rounds > 1:  # the rows of a large corpus make room; others are left to expire like all scratch
                for d in deals:
                    removed(spark, f"{scratch['word-rows']}/_deal={d}")

        held = index.table(spark, "postings").groupBy("word_id").agg(F.sum(F.size("entries.times")).cast("long").alias("n"))
        words = words.drop("n").join(held, "word_id").select("word", "n", F.length("word").alias("wlen"), "word_id")
        words = words.repartitionByRange("wlen", "word").sortWithinPartitions("wlen", "word")
        words.write.options(**PACKED).parquet(f"{path}/words")

        beginning = F.substring("word", 1, PREFIX)
        heads = index.table(spark, "words").select(beginning.alias("word")).distinct()
        heads.write.options(**PACKED).parquet(scratch["word-heads"])
        _write_neighbours(_read(spark, heads, scratch["word-heads"]), index)
    return index


def _read(spark: SparkSession, written: DataFrame, path: str) -> DataFrame:
    return spark.read.schema(written.schema).parquet(path)


def _word_id(word: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), word)


def _part(key: Column | str, parts: int) -> Column:
    """The folder of what is looked up by ``key``."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _free_seed(counts: DataFrame) -> tuple[int, int]:
    """A seed with which no two words have one id (the first nearly always: ids have 64 bits), and the rows of all words."""
    seed = 0
    while True:
        ids = counts.select("n", _word_id(F.col("word"), seed).alias("id"))
        n, distinct, rows = ids.agg(F.count(F.lit(1)), F.count_distinct("id"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if distinct == n:
            return seed, rows
        seed += 1


def _write_postings(listed: DataFrame, index: WordIndex, files: int, posting_rows: int, more: bool) -> None:
    """One folder per part of the words of ``listed``, with blocks of their rows.

    The rows are dealt by files (about ``files`` of a part, and further ones for each ``FILE_BLOCKS`` blocks of
    a word), so a part that is large is written by several tasks, and what is written is worked out once: a sort by
    ranges would make it a second time for its sample.  A word's rows in a file are counted and cut into blocks there.
    """
    columns = [f"_k{i}" for i in range(len(index.keys))]
    block = F.pmod(F.xxhash64(*columns), F.coalesce("_blocks", F.lit(1).cast("long")))
    file = F.pmod(F.xxhash64("word_id"), F.lit(files)) + files * F.floor(F.col("block") / FILE_BLOCKS)
    dealt = listed.withColumn("block", block).drop("_blocks").withColumn("_file", file * index.parts + _part("word_id", index.parts))
    dealt = dealt.repartition(index.parts * files, "_file")
    # word_id comes first, as sorts by it alone are settled by their prefix
    found = dealt.groupBy("word_id", "_file", *columns).agg(F.count(F.lit(1)).alias("times"))
    entry = F.struct(*[F.col(c).alias(k) for c, k in zip(columns, index.keys)], "times")
    found = found.groupBy("word_id", "_file").agg(F.collect_list(entry).alias("_all"))
    cuts = F.sequence(F.lit(1), F.size("_all"), F.lit(posting_rows))
    found = found.select("word_id", "_file", F.posexplode(F.transform(cuts, lambda start: F.slice("_all", start, posting_rows))).alias("_at", "entries"))
    block = F.floor(F.col("_file") / (files * index.parts)) * (2 * FILE_BLOCKS) + F.col("_at")  # no two of a word are equal
    part = F.pmod("_file", F.lit(index.parts)).cast("int")
    found = found.select("word_id", block.cast("long").alias("block"), "entries", part.alias("part"))
    found = found.sortWithinPartitions("part", "word_id", "block").write.options(**PACKED).partitionBy("part")
    found.mode("append" if more else "errorifexists").parquet(f"{index.path}/postings")


def _write_neighbours(heads: DataFrame, index: WordIndex) -> None:
    """One folder per part of the rests of ``heads`` (``word``).  The heads are dealt to the tasks, not the many
    more rests: each task writes those of its heads into all folders."""
    most = sum(math.comb(PREFIX, k) for k in range(min(index.edits, PREFIX) + 1))
    tasks = -(-heads.count() * most // NEAR_ROWS) or 1
    rests = F.explode(deletions(F.col("word"), index.edits)).alias("rest")
    near = heads.repartition(tasks, "word").select(_head(F.col("word")).alias("head"), rests)
    near = near.select(F.hash("rest").alias("key"), "head").withColumn("part", _part("key", index.parts))
    near.write.options(**PACKED).partitionBy("part").parquet(f"{index.path}/neighbours")


def _looked_up(spark: SparkSession, index: WordIndex, name: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of the table ``name`` joined to ``wanted`` on ``key``.

    ``wanted`` is written once.  The folders it falls into (``index.parts`` at most) become a literal
    condition, so the others are not read; and it is broadcast if it is measured as small.
    """
    with session_conf(spark, {SHUFFLES_DROPPED: "true"}):
        wanted = stored(wanted.withColumn("part", _part(key, index.parts)), f"wanted-{name}")
    parts = [r[0] for r in wanted.select("part").distinct().collect()]
    if fits_for_broadcast(wanted, BROADCAST_ROWS, BROADCAST_BYTES):
        wanted = F.broadcast(wanted)
    return index.table(spark, name).where(F.col("part").isin(parts)).join(wanted, ["part", key])


def near_words(spark: SparkSession, index: WordIndex, text: str | None, limit: int = DISTANCE_LIMIT) -> DataFrame:
    """``word_id``, ``word`` of the indexed words within ``limit - 1`` edits of a term of ``text``: each distinct
    word of the length bands is tested once."""
    words = index.table(spark, "words")
    terms = list(dict.fromkeys(split_terms(text)))
    if not terms:
        return words.limit(0).select("word_id", "word")
    return words.where(length_bands("wlen", terms, limit)).where(near_any("word", terms, limit)).select("word_id", "word")


def near_pairs(spark: SparkSession, index: WordIndex, terms: DataFrame, term_col: str = "term") -> DataFrame:
    """``word_id``, ``word`` and term of all pairs within ``index.edits`` edits, for a table of distinct terms.

    Terms and heads meet on equal hashes of a rest, and bring the words with these heads whose length allows a match;
    the distance is tested on what meets, once per pair.
    """
    asked = terms.select(F.col(term_col).alias("term"), F.explode(deletions(F.col(term_col), index.edits)).alias("rest"))
    asked = asked.select("term", F.hash("rest").alias("key")).distinct()
    met = _looked_up(spark, index, "neighbours", asked, "key").select("head", "term").distinct()
    words = index.table(spark, "words").select("word_id", "word", "wlen", _head(F.col("word")).alias("head"))
    pairs = met.join(words, "head").where(F.abs(F.col("wlen") - F.length("term")) <= index.edits).select("word_id", "term", "word")
    return pairs.where(F.levenshtein("word", "term", index.edits) >= 0)


def rows_of_words(spark: SparkSession, index: WordIndex, found: DataFrame, every_time: bool = True) -> DataFrame:
    """The rows that hold the words of ``found`` (``word_id`` and further columns), from the postings alone:
    ``index.keys`` and the further columns; a row once for each time it holds the word, or
    (``every_time=False``) once."""
    more = [c for c in found.columns if c != "word_id"]
    hits = _looked_up(spark, index, "postings", found, "word_id")
    hits = hits.select(*more, F.explode("entries").alias("_e")).select(*[f"_e.{k}" for k in index.keys], *more, "_e.times")
    return expand(hits, "times") if every_time else hits.drop("times")


def indexed_fuzzy_filter(
    spark: SparkSession, index: WordIndex, text: str | None, word_col: str = WORD_COL, limit: int = DISTANCE_LIMIT
) -> DataFrame:
    """``fuzzy_filter`` on an index: the same rows (``index.keys`` and the word)."""
    found = near_words(spark, index, text, limit).withColumnRenamed("word", word_col)
    return rows_of_words(spark, index, found)


def indexed_documents(
    spark: SparkSession, index: WordIndex, text: str | None, limit: int = DISTANCE_LIMIT
) -> DataFrame:
    """The distinct rows (``index.keys``) with a word within ``limit - 1`` edits of a term of ``text``."""
    found = near_words(spark, index, text, limit).select("word_id")
    return rows_of_words(spark, index, found, every_time=False).distinct()


def indexed_fuzzy_join(
    spark: SparkSession, index: WordIndex, searches: DataFrame, parameter_col: str = "parameter",
    word_col: str = WORD_COL, term_col: str = "parameters",
) -> DataFrame:
    """``fuzzy_join`` on an index: ``index.keys``, the word, the columns of ``searches`` and the matching term."""
    asked = searches.select("*", explode_words(parameter_col).alias(term_col))
    pairs = near_pairs(spark, index, asked.select(F.col(term_col).alias("term")).distinct())
    matched = rows_of_words(spark, index, pairs.withColumnRenamed("word", word_col).withColumnRenamed("term", "_term"))
    return matched.join(asked, F.col("_term") == F.col(term_col)).drop("_term")


def indexed_terms_filter(
    spark: SparkSession, index: WordIndex, terms: DataFrame, term_col: str = "term", word_col: str = WORD_COL
) -> DataFrame:
    """Rows with a word near any of a table of terms, each row once per time it holds the word."""
    found = near_pairs(spark, index, terms.select(term_col).where(F.col(term_col).isNotNull()).distinct(), term_col)
    return rows_of_words(spark, index, found.select("word_id", F.col("word").alias(word_col)).distinct())
