"""The stored inverted index and its deletion neighbourhoods against the plain searches."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from placeseek.operators.search import fuzzy_filter, fuzzy_join, length_bands
from placeseek.plans.search import word_corpus
from placeseek.plans.word_index import (
    PREFIX,
    build_word_index,
    deletions,
    indexed_documents,
    indexed_fuzzy_filter,
    indexed_fuzzy_join,
    indexed_terms_filter,
    near_pairs,
    near_words,
    rows_of_words,
)

WORDS = ["", "a", "ab", "abc", "abcd", "bcd", "xabcd", "abxcd", "São", "Sao", "barcela", "Barcelona", "Barcela", "zzzzzzzzzz", None, "ab", "éé", "dcba"]


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = word_corpus(docs, cols=None, text_col="text", keep=["doc_id", "lang", "source"])
    return words, build_word_index(words, str(tmp_path_factory.mktemp("index") / "docs"), ["doc_id", "lang", "source"])


def test_indexed_search_equals_plain_search(spark, documents):
    words, index = documents
    for text in ["erblest therouou", "èheaux zzqqzzqq", " a", "Ouréaux", "", None]:
        plain = fuzzy_filter(words, text).select("doc_id", "lang", "source", "palavras")
        assert _same(indexed_fuzzy_filter(spark, index, text), plain), text
        assert _same(indexed_documents(spark, index, text), plain.drop("palavras").distinct()), text


def test_the_corpus_is_not_read_and_folders_are_pruned(spark, documents):
    _, index = documents
    found = near_words(spark, index, "erblest").select("word_id")
    rows = rows_of_words(spark, index, found, every_time=False)
    read = {f.split("/docs/")[1].split("/")[0] for f in rows.inputFiles() if "/docs/" in f}
    assert read == {"postings"}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part#" in plan
    n = found.select(F.pmod(F.xxhash64("word_id"), F.lit(index.parts)).alias("p")).distinct().count()
    assert 0 < n < index.parts


def test_each_distinct_word_is_tested_once(spark, documents):
    words, index = documents
    stored = index.table(spark, "words")
    assert stored.count() == words.select("palavras").distinct().count()
    assert stored.select("word_id").distinct().count() == stored.count()
    plan = near_words(spark, index, "erblest")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(wlen,5)" in plan and "LessThanOrEqual(wlen,9)" in plan


def test_hot_words_have_many_blocks(spark, tmp_dir):
    rows = spark.range(5000).select("id", F.lit("the").alias("palavras"))
    index = build_word_index(rows.union(rows.limit(1)), tmp_dir + "/i", ["id"], posting_rows=100)
    blocks = index.table(spark, "postings").select(F.size("entries").alias("n"))
    assert blocks.count() == 50 and blocks.agg(F.max("n")).first()[0] < 200
    assert indexed_fuzzy_filter(spark, index, "thx").count() == 5001


def test_deletions_share_a_rest_exactly_up_to_the_distance(spark):
    rnd = random.Random(2)
    pairs = []
    for _ in range(4000):
        a = "".join(rnd.choice("ab é") for _ in range(rnd.randint(0, 13)))
        b = list(a)
        for _ in range(rnd.randint(0, 3)):
            at, kind = rnd.randint(0, len(b)), rnd.randint(0, 2)
            b[at : at + (kind > 0)] = [] if kind == 2 else [rnd.choice("ab é")]
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2):
        shared = F.arrays_overlap(deletions(F.col("a"), edits), deletions(F.col("b"), edits))
        assert df.where((F.levenshtein("a", "b") <= edits) & ~shared).count() == 0
    most = spark.createDataFrame([("abcdefghijklmnop" * 50,)], "w string").select(F.size(deletions(F.col("w"), 2))).first()[0]
    assert most == 1 + PREFIX + PREFIX * (PREFIX - 1) // 2


def test_near_pairs_equal_all_pairs(spark, tmp_dir):
    rnd = random.Random(3)
    known = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(400)})
    words = spark.createDataFrame([(i, w) for i, w in enumerate(known)], "id int, palavras string")
    terms = spark.createDataFrame([(w[:3] + "b" + w[4:],) for w in known[::4]] + [("",), ("a",), ("cba" * 5,)], "term string").distinct()
    index = build_word_index(words, tmp_dir + "/i", ["id"])
    want = words.join(terms, F.levenshtein("palavras", "term") <= 2).select("palavras", "term")
    assert want.count() > 1000
    assert _same(near_pairs(spark, index, terms).select("word", "term"), want)


def test_table_of_searches_on_the_index(spark, tmp_dir):
    words = spark.createDataFrame(list(enumerate(WORDS)) + [(7, "abxcd")], "id int, palavras string")
    index = build_word_index(words, tmp_dir + "/i", ["id"])
    searches = spark.createDataFrame(list(enumerate(["abcd", " a", "ab ab", "Barcela São", "", None, "zzzz", "éa Barcelona"])), "search int, parameter string")
    got, want = indexed_fuzzy_join(spark, index, searches), fuzzy_join(words, searches)
    assert got.columns == want.columns and want.count() > 30 and _same(got, want)
    terms = spark.createDataFrame([("abcd",), ("Barcela",), ("abcd",), (None,)], "term string")
    assert _same(indexed_terms_filter(spark, index, terms), fuzzy_filter(words, "abcd Barcela"))
    empty = build_word_index(words.limit(0), tmp_dir + "/e", ["id"])
    assert indexed_fuzzy_join(spark, empty, searches).count() == indexed_documents(spark, empty, "a").count() == 0
    assert indexed_fuzzy_join(spark, index, searches.limit(0)).count() == 0


def test_length_bands(spark):
    lengths = spark.range(0, 40).withColumnRenamed("id", "n")
    for terms in ([""], ["a", "abc"], ["a" * 5, "a" * 9, "a" * 30], ["a" * i for i in range(3000)]):
        got = {r.n for r in lengths.where(length_bands("n", terms)).collect()}
        assert got == {n for n in range(40) if any(abs(n - len(t)) < 3 for t in terms)}


def test_the_index_is_built_without_a_sort_or_join_of_all_rows(spark, tmp_dir, monkeypatch):
    """Only the words are dealt by ranges, whose sample works everything out twice; a hot word's blocks go to several tasks."""
    from placeseek.plans import word_index as module

    kind, ranged, dealt = type(spark.range(0)), [], []
    by_range, by_hash = kind.repartitionByRange, kind.repartition
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, *a: (ranged.append(self.columns), by_range(self, *a))[1])
    monkeypatch.setattr(kind, "repartition", lambda self, *a: (dealt.append(by_hash(self, *a)), dealt[-1])[1])
    monkeypatch.setattr(module, "FILE_BLOCKS", 4)
    rows = spark.range(3000).select("id", F.explode(F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id") % 50))).alias("palavras"))
    index = build_word_index(rows, tmp_dir + "/i", ["id"], posting_rows=100, parts=4)
    assert ranged == [["word", "n", "wlen", "word_id"]] and len(dealt) == 2
    the = dealt[0].where(F.col("block").isNotNull()).groupBy("word_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_file").alias("f"))
    assert [r["f"] for r in the.where("n = 3000").collect()] == [8]
    assert _same(indexed_fuzzy_filter(spark, index, "the w7"), fuzzy_filter(rows, "the w7"))


def test_words_of_equal_hash_get_ids_of_their_own(spark, tmp_dir, monkeypatch):
    from placeseek.plans import word_index as module

    plain = module._word_id
    monkeypatch.setattr(module, "_word_id", lambda word, seed: F.length(word).cast("long") if seed < 2 else plain(word, seed))
    words = spark.createDataFrame(list(enumerate(WORDS)), "id int, palavras string")
    index = build_word_index(words, tmp_dir + "/i", ["id"])
    assert index.table(spark, "words").select("word_id").distinct().count() == len({w for w in WORDS if w is not None})
    assert _same(indexed_fuzzy_filter(spark, index, "abcd São"), fuzzy_filter(words, "abcd São"))
