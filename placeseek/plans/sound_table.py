"""Words by their sound code, stored in buckets (JON4).

The code of each distinct word is worked out once.  The table is bucketed and sorted by code, so a search for
some codes reads their buckets only, and two such tables meet word by word without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.functions.phonetic import soundex_code
from placeseek.functions.text import split_terms
from placeseek.operators.search import term_codes
from placeseek.plans.search import WORD_COL

BUCKETS = 64
#: Tasks that share the writing of a bucket, so a code that very many words have is not one task's.
WRITERS = 4


def store_sound_table(corpus: DataFrame, name: str, path: str, word_col: str = WORD_COL, buckets: int = BUCKETS) -> None:
    """Store the distinct words of ``corpus`` as the table ``name`` at ``path``: ``code``, ``word``, ``n`` (rows).
    Words without a code (no ASCII letter) are left out, as they sound like nothing."""
    words = corpus.where(F.col(word_col).isNotNull()).groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    coded = words.select(soundex_code("word").alias("code"), "word", "n").where("code != ''")
    dealt = coded.repartition(buckets * WRITERS, "code", F.pmod(F.xxhash64("word"), F.lit(WRITERS)))
    dealt.write.bucketBy(buckets, "code").sortBy("code").option("path", path).mode("overwrite").saveAsTable(name)


def words_like(spark: SparkSession, name: str, text: str | None) -> DataFrame:
    """Rows of the table whose word sounds like a term of ``text``."""
    table = spark.read.table(name)
    terms = split_terms(text)
    codes = sorted({c for c in term_codes(spark, terms) if c}) if terms else []
    return table.where(F.col("code").isin(codes)) if codes else table.limit(0)


def sound_pairs(spark: SparkSession, left: str, right: str) -> DataFrame:
    """``code``, the words of both tables that have it, and how often each word occurs."""
    a = spark.read.table(left).select("code", F.col("word").alias("left_word"), F.col("n").alias("left_n"))
    b = spark.read.table(right).select("code", F.col("word").alias("right_word"), F.col("n").alias("right_n"))
    return a.join(b.hint("merge"), "code")
