"""Fixed values for the text, distance and sound-code functions."""

from pyspark.sql import functions as F

from placeseek.functions import (
    near_any,
    register_sql_functions,
    search_text,
    soundex_code,
    split_terms,
    split_words,
    title_case,
    within_distance,
)


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_reference_soundex_words(spark):
    # The source application's one test, five words and their codes.
    words = ["Hello", "World", "OpenAI", "GPT", "Test"]
    got = one(spark, soundex_code("w"), [(w,) for w in words], "w string")
    assert got == ["H400", "W643", "O150", "G130", "T230"]


def test_soundex_letters_only(spark):
    cases = {
        "12ab": "A100",
        " Hello": "H400",
        "": "",
        "Ashcraft": "A261",
        "Pfister": "P236",
        "Tymczak": "T522",
        "O'Brien": "O165",
        "De Smith": "D253",
        "Washington": "W252",
    }
    got = one(spark, soundex_code("w"), [(w,) for w in cases], "w string")
    assert got == list(cases.values())
    assert one(spark, soundex_code("w"), [(None,)], "w string") == [None]
    # accented letters are dropped, or folded on request
    assert one(spark, soundex_code("w"), [("São",)], "w string") == ["S000"]
    assert one(spark, soundex_code("w", fold=True), [("São",)], "w string") == ["S000"]
    # the fold keeps a leading accented letter: Ébano codes as Ebano, not bano
    assert one(spark, soundex_code("w"), [("Ébano",)], "w string") == ["B500"]
    assert one(spark, soundex_code("w", fold=True), [("Ébano",)], "w string") == ["E150"]


def test_initcap(spark):
    rows = [("ESTADOS UNIDOS",), ("guiné-bissau d'ivoire",), (None,)]
    assert one(spark, title_case("s"), rows, "s string") == [
        "Estados Unidos",
        "Guiné-bissau D'ivoire",
        None,
    ]


def test_concat_ws(spark):
    df = spark.createDataFrame([(1, None, "", "x"), (None, None, None, None)], "a int, b string, c string, d string")
    got = [r[0] for r in df.select(search_text(["a", "b", "c", "d"])).collect()]
    assert got == ["1  x", ""]


def test_split_on_blanks(spark):
    rows = [(" a  b ",), ("",), ("a b",)]
    got = one(spark, split_words("s"), rows, "s string")
    assert got == [["", "a", "b", ""], [""], ["a b"]]
    # the driver-side split of a search text agrees with Spark's
    for (text,) in rows:
        assert split_terms(text) == one(spark, split_words(F.lit(text)), [(1,)], "x int")[0]
    assert split_terms(None) == []


def test_edit_distance(spark):
    rows = [("Barcela", "Barcelona"), ("barcela", "Barcelona"), ("São", "Sao"), ("", "ab"), (None, "a")]
    got = one(spark, F.levenshtein("a", "b"), rows, "a string, b string")
    assert got == [2, 3, 1, 2, None]
    bounded = one(spark, F.levenshtein("a", "b", 2), [("Barcela", "Barcelona"), ("Barcela", "Madrid")], "a string, b string")
    assert bounded == [2, -1]


def test_bounded_predicate_equals_plain(spark):
    words = ["Barcela", "Barcelona", "barcelona", "Sao", "São", "", "ab", "abc", "x", None, "Bar"]
    terms = ["Barcelona", "", "Sao"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for limit in (1, 2, 3, 4):
        fast = {r[0] for r in df.filter(near_any("w", terms, limit)).collect()}
        plain = set()
        for t in terms:
            plain |= {r[0] for r in df.filter(F.levenshtein("w", F.lit(t)) < limit).collect()}
        assert fast == plain, limit
        col_form = {r[0] for r in df.filter(within_distance("w", F.lit("Barcelona"), limit)).collect()}
        assert col_form == {r[0] for r in df.filter(F.levenshtein("w", F.lit("Barcelona")) < limit).collect()}


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT soundex_udf('Ashcraft') a, soundex_udf(NULL) b, phonetic_code('Tymczak') c, soundex_udf('12ab') d"
    ).collect()[0]
    assert tuple(row) == ("A261", None, "T522", "A100")
