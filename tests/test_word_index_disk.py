"""What the word index takes of disk while it is built, and afterwards."""

import os
import time
from collections import Counter

from pyspark.sql import functions as F

from placeseek.functions.distance import PREFIX
from placeseek.operators.search import fuzzy_filter
from placeseek.plans import word_index as module
from placeseek.plans.word_index import build_word_index, indexed_fuzzy_filter, near_pairs
from placeseek.session import SHUFFLES_DROPPED


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_words_of_one_beginning_share_their_neighbours(spark, tmp_dir):
    known = [f"abcdefgh{'x' * (i % 3)}{i}" for i in range(300)] + ["abc", "abcdefg", "zz"]
    words = spark.createDataFrame(list(enumerate(known)), "id int, palavras string")
    index = build_word_index(words, tmp_dir + "/i", ["id"])
    most = 1 + PREFIX + PREFIX * (PREFIX - 1) // 2
    near = index.table(spark, "neighbours")
    assert near.count() == most + (1 + 3 + 3) + (1 + 7 + 21) + (1 + 1 + 1)  # not once for each of the 300
    terms = spark.createDataFrame([(t,) for t in ["abcdefgh17", "abdefghx1", "abc", "abcdefghxx200", "zabcdefgh3", "z", "q"]], "term string")
    want = words.join(terms, F.levenshtein("palavras", "term") <= 2).select("palavras", "term")
    assert want.count() > 100 and _same(near_pairs(spark, index, terms).select("word", "term"), want)


def test_rows_are_shuffled_by_rounds_and_dropped(spark, tmp_dir, monkeypatch):
    """Several rounds give what one does; when the index is built, no row on its way to it is left."""
    monkeypatch.setattr(module, "ROUND_ROWS", 500)
    rows = spark.range(2000).select("id", F.explode(F.array(F.lit("the"), F.concat(F.lit("word"), F.col("id") % 50), F.lit("the"))).alias("palavras"))
    rows = rows.select(F.when(F.col("id") % 7 > 0, F.col("id") % 1000).alias("id"), "palavras").repartition(5, "palavras", "id").cache()
    rows.count()
    before, setting, paths = _shuffled(spark), spark.conf.get(SHUFFLES_DROPPED), []
    plain = module.scratch_path
    monkeypatch.setattr(module, "scratch_path", lambda *a: paths.append(plain(*a)) or paths[-1])
    index = build_word_index(rows, tmp_dir + "/i", ["id"], posting_rows=100)
    assert spark.conf.get(SHUFFLES_DROPPED) == setting
    written = next(p for p in paths if "word-rows" in p).removeprefix("file:")
    assert not [f for _, _, files in os.walk(written) for f in files if f.endswith(".parquet")]
    for _ in range(60):  # Spark drops them in the background
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.5)
    assert not left
    assert _same(indexed_fuzzy_filter(spark, index, "thee word1"), fuzzy_filter(rows, "thee word1"))

    held = Counter(r["palavras"] for r in rows.distinct().collect())
    assert {r["word"]: r["n"] for r in index.table(spark, "words").collect()} == held
    blocks = index.table(spark, "postings").select("word_id", "block", F.size("entries").alias("size")).collect()
    assert len({(r["word_id"], r["block"]) for r in blocks}) == len(blocks)
    assert max(r["size"] for r in blocks) == 100 and len(blocks) == sum(-(-n // 100) for n in held.values())
    rows.unpersist()
