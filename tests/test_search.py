"""Fuzzy and sound-alike search against the reference's plain formulation."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from placeseek.operators import fuzzy_filter, fuzzy_pairs, phonetic_filter
from placeseek.plans.search import fuzzy_matches, fuzzy_search, word_corpus
from placeseek.plans.shapes import part_as_workbook


def _reference_form(words, text, limit=3):
    """The reference's own steps: constant column, two explodes, plain distance."""
    return (
        words.withColumn("parameter", F.lit(text))
        .withColumn("parameters", F.explode(F.split(F.col("parameter"), r"\s+")))
        .filter(F.levenshtein(F.col("palavras"), F.col("parameters")) < limit)
        .drop("parameter", "parameters")
    )


def _doc_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return word_corpus(docs, cols=None, text_col="text", keep=["doc_id"])


def test_bounded_equals_plain_on_documents(spark):
    words = _doc_words(spark)
    for text in ["erblest therouou", "èheaux zzqqzzqq", " a", "xqzwkvjy qqqqqqqqqq", "Ouréaux"]:
        ours = fuzzy_filter(words, text).distinct()
        ref = _reference_form(words, text).distinct()
        assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0, text


def test_empty_and_null_search(spark):
    words = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "a"), (4, "")], "id int, palavras string")
    assert sorted(r.id for r in fuzzy_filter(words, "").collect()) == [1, 3, 4]
    assert fuzzy_filter(words, None).count() == 0
    # a leading blank adds the term ''
    assert sorted(r.id for r in fuzzy_filter(words, " zzzzzz").collect()) == [1, 3, 4]


def test_fuzzy_search_records(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    corpus = word_corpus(part_as_workbook(part))
    found = fuzzy_matches(corpus, "smal rng")
    ref = _reference_form(corpus, "smal rng").select(*found.columns).distinct()
    assert found.exceptAll(ref).count() == 0 and ref.exceptAll(found).count() == 0
    page = fuzzy_search(corpus, "smal rng")
    assert page.columns == ["linha", "municipios", "tipo", "h", "cep", "paisSKU", "municipioSKU"]
    rows = page.collect()
    assert len(rows) == min(10, found.count())
    assert [r.linha for r in rows] == sorted(r.linha for r in rows)
    second = fuzzy_search(corpus, "smal rng", page=2).collect()
    assert not {tuple(r) for r in rows} & {tuple(r) for r in second}


def test_phonetic_filter(spark):
    words = spark.createDataFrame(
        [(1, "Robert"), (2, "Rupert"), (3, "Rubin"), (4, "123"), (5, None)], "id int, palavras string"
    )
    assert sorted(r.id for r in phonetic_filter(words, "Robert").collect()) == [1, 2]
    assert phonetic_filter(words, "").count() == 0
    assert phonetic_filter(words, None).count() == 0


def test_phonetic_prefilter_is_exact(spark):
    words = spark.createDataFrame(
        [(1, "Tymczak"), (2, "tamsack"), (3, "1tymczak"), (4, "ıTymczak"), (5, "éTymczak"), (6, "Xymczak"), (7, "")],
        "id int, palavras string",
    )
    got = sorted(r.id for r in phonetic_filter(words, "Tymczak").collect())
    plain = sorted(
        r.id
        for r in words.filter(
            F.soundex(F.regexp_replace("palavras", "[^A-Za-z]", "")) == F.lit("T522")
        ).collect()
    )
    assert got == plain == [1, 2, 3, 4, 5]


def test_fuzzy_pairs_keep_the_reference_row_shape(spark):
    words = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "zzzzzz")], "id int, palavras string")
    got = sorted((r.id, r.parameters) for r in fuzzy_pairs(words, "ab abd ab").collect())
    # "ab" is typed twice: each typed term is one match, as in the reference
    assert got == [(1, "ab"), (1, "ab"), (1, "abd"), (2, "ab"), (2, "ab"), (2, "abd")]
    assert fuzzy_pairs(words, "ab abd ab").count() == _reference_form(words, "ab abd ab").count()
    assert fuzzy_pairs(words, None).count() == 0


def test_phonetic_pairs(spark):
    from placeseek.operators import phonetic_pairs

    words = spark.createDataFrame([(1, "Robert"), (2, "Rupert"), (3, "Tymczak"), (4, "x")], "id int, palavras string")
    got = sorted((r.id, r.parameters) for r in phonetic_pairs(words, "Rupert Tymczak 12").collect())
    assert got == [(1, "Rupert"), (2, "Rupert"), (3, "Tymczak")]
    assert phonetic_pairs(words, "123").count() == 0


def test_stored_corpus_search_equals_direct(spark, tmp_dir):
    from placeseek.plans.search import store_corpus, stored_fuzzy_filter

    words = _doc_words(spark)
    path = tmp_dir + "/corpus"
    store_corpus(words, path)
    stored = spark.read.parquet(path)
    for text in ["erblest therouou", " a", "Ouréaux"]:
        a = stored_fuzzy_filter(stored, text).select(*words.columns)
        b = fuzzy_filter(words, text)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, text
    assert stored_fuzzy_filter(stored, None).count() == 0


def test_a_thousand_terms(spark):
    import random

    rnd = random.Random(4)
    words = _doc_words(spark).select("doc_id", "palavras")
    known = [r[0] for r in words.select("palavras").distinct().orderBy("palavras").limit(1500).collect()]
    terms = [w[: rnd.randint(0, len(w))] + rnd.choice("abcé") + w[-2:] for w in rnd.sample(known, 1000)]
    text = " ".join(terms)
    ours = fuzzy_filter(words, text).distinct()
    ref = _reference_form(words, text).distinct()
    assert ours.count() > 0 and ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_table_of_searches_equals_single_searches(spark):
    from placeseek.operators import fuzzy_join

    words = spark.createDataFrame(
        [(i, w) for i, w in enumerate(["", "a", "ab", "abc", "abcd", "bcd", "xabcd", "abxcd", "São", "Sao", "barcela", "Barcelona", "Barcela", "zzzzzzzzzz", None, "ab", "éé", "dcba"])],
        "id int, palavras string",
    )
    texts = ["abcd", " a", "ab ab", "Barcela São", "", None, "zzzz", "éa Barcelona"]
    searches = spark.createDataFrame(list(enumerate(texts)), "search int, parameter string")
    got = fuzzy_join(words, searches)
    assert got.columns == ["id", "palavras", "search", "parameter", "parameters"]
    rows = sorted((r.search, r.id, r.parameters) for r in got.collect())
    want = sorted((k, r.id, r.parameters) for k, t in enumerate(texts) for r in fuzzy_pairs(words, t).collect())
    assert rows == want and len(want) > 30
    assert fuzzy_join(words.limit(0), searches).count() == fuzzy_join(words, searches.limit(0)).count() == 0


def test_many_terms_on_stored_corpus_and_by_sound(spark, tmp_dir):
    """Thousands of terms neither overflow the plan nor slow it down with their number."""
    import random
    import time

    from placeseek.operators import phonetic_pairs
    from placeseek.operators.search import term_codes
    from placeseek.plans.search import store_corpus, stored_fuzzy_filter

    rnd = random.Random(8)
    terms = ["".join(rnd.choice("abcdefghijklmnoprstuvwé") for _ in range(rnd.randint(1, 14))) for _ in range(3000)] + ["Robert", "Robert", "12"]
    words = spark.createDataFrame([(i, t[:-1] + "x") for i, t in enumerate(terms[::7])] + [(-1, "Rupert"), (-2, "34")], "id int, palavras string")
    store_corpus(words, tmp_dir + "/c")
    got = stored_fuzzy_filter(spark.read.parquet(tmp_dir + "/c"), " ".join(terms)).select("id", "palavras")
    want = fuzzy_filter(words, " ".join(terms))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 400
    start = time.perf_counter()
    pairs = [tuple(r) for r in phonetic_pairs(words, " ".join(terms)).select("id", "parameters").collect()]
    assert time.perf_counter() - start < 20
    codes = dict(zip(terms, term_codes(spark, terms)))
    own = {r.id: r.c for r in words.select("id", F.soundex(F.regexp_replace("palavras", "[^A-Za-z]", "")).alias("c")).collect()}
    assert sorted(pairs) == sorted((i, t) for i, c in own.items() for t in terms if c and codes[t] == c)
    assert pairs.count((-1, "Robert")) == 2


def _odd_words(spark):
    import random

    rnd = random.Random(11)
    some = ["".join(rnd.choice("ab é😀") for _ in range(rnd.randint(0, 12))) for _ in range(300)] + ["", None, "ab", "ab"]
    rows = [(i % 90, w) for i, w in enumerate(some * 3)]
    terms = ["".join(rnd.choice("abé😀") for _ in range(rnd.randint(1, 11))) for _ in range(60)]
    return spark.createDataFrame(rows, "id int, palavras string"), " " + " ".join([*terms, terms[0]])


def test_many_terms_are_not_tested_against_every_row(spark):
    from placeseek.functions.distance import near_any
    from placeseek.functions.text import split_terms

    words, text = _odd_words(spark)
    for limit in (0, 1, 2, 3, 4):
        got, want = fuzzy_filter(words, text, limit=limit), words.filter(near_any("palavras", split_terms(text), limit))
        assert got.columns == words.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), limit
        assert (limit == 0) == got.isEmpty()
    assert "levenshtein" not in fuzzy_filter(words, text)._jdf.queryExecution().executedPlan().toString()


def test_many_terms_on_a_stored_corpus_are_not_tested_against_every_row(spark, tmp_dir):
    from placeseek.plans.search import store_corpus, stored_fuzzy_filter

    words, text = _odd_words(spark)
    store_corpus(words, tmp_dir + "/c")
    stored = spark.read.parquet(tmp_dir + "/c")
    found = stored_fuzzy_filter(stored, text)
    got, want = found.select(*words.columns), fuzzy_filter(words, text)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" not in plan and "LessThanOrEqual(wlen" in plan
