"""Joins: two keys, nulls and empties, fan-out, salting of hot keys."""

from pyspark.sql import functions as F

from placeseek.operators import left_join, left_join_twice
from placeseek.plans.enrich import enrich_cities, enrich_cities_as_reference
from placeseek.session import fits_for_broadcast

CITY = "skuIBGE string, siglaPais string, municipio string, pais string, uf string"
STATE = "localCode string, nomeEstado string, continente string, siglaPaisEstado string"


def test_two_key_left_join_edges(spark):
    cities = spark.createDataFrame(
        [
            ("1", "BR", "Campinas", "BRASIL", "SP"),
            ("2", "BR", "Nowhere", "BRASIL", None),
            ("3", "BR", "Empty", "BRASIL", ""),
            ("4", "BR", "Lost", "BRASIL", "ZZ"),
            ("5", "PT", "Porto", "portugal", "SP"),
        ],
        CITY,
    )
    states = spark.createDataFrame(
        [("SP", "São Paulo", "SA", "BR"), (None, "Empty", "EU", "PT"), ("13", "Porto D", "EU", "PT")],
        STATE,
    )
    out = {r.skuIBGE: r for r in enrich_cities(cities, states).collect()}
    assert out["1"].nomeEstado == "São Paulo" and out["1"].continente == "SA"
    for key in ("2", "3", "4", "5"):
        assert out[key].nomeEstado is None and out[key].continente is None
    assert out["5"].paisCamel == "Portugal" and out["1"].paisCamel == "Brasil"
    assert len(out) == 5
    assert enrich_cities(cities, states).columns == [*cities.columns, "paisCamel", "nomeEstado", "continente"]


def test_fan_out_once_and_twice(spark):
    cities = spark.createDataFrame([("1", "BR", "A", "X", "SP"), ("2", "BR", "B", "X", "RJ")], CITY)
    states = spark.createDataFrame(
        [("SP", "Sao Paulo", "SA", "BR"), ("SP", "Sao Paulo 2", "SA", "BR"), ("RJ", "Rio", "SA", "BR")],
        STATE,
    )
    once = enrich_cities(cities, states)
    twice = enrich_cities_as_reference(cities, states)
    assert once.filter("skuIBGE = '1'").count() == 2
    assert twice.filter("skuIBGE = '1'").count() == 4
    assert twice.filter("skuIBGE = '2'").count() == 1
    # the shuffle form (no broadcast) gives the same rows
    shuffled = enrich_cities_as_reference(cities, states, broadcast_rows=None)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, twice.collect()))


def _hot_tables(spark):
    # one key holds a third of the right side's rows
    right = spark.range(0, 900).select(
        F.when(F.col("id") < 300, F.lit(7)).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("v"),
    )
    left = spark.range(0, 150).select((F.col("id") - 20).alias("k"), (F.col("id") * 10).alias("w"))
    return left, right


def test_salted_left_join_matches_plain(spark):
    left, right = _hot_tables(spark)
    plain = left_join(left, right, [("k", "k")], broadcast_rows=None)
    salted = left_join(left, right, [("k", "k")], broadcast_rows=None, salt_rows=40)
    assert plain.count() == salted.count()
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_salted_twice_matches_brute_force(spark):
    left, right = _hot_tables(spark)
    left.createOrReplaceTempView("l_hot")
    right.createOrReplaceTempView("r_hot")
    brute = spark.sql(
        "SELECT c.k, c.w, s.v FROM (SELECT l.*, r.v AS v1 FROM l_hot l LEFT JOIN r_hot r ON l.k = r.k) c "
        "LEFT JOIN r_hot s ON c.k = s.k"
    )
    ours = left_join_twice(
        left, right.withColumnRenamed("k", "rk"), [("k", "rk")], ["k", "w"], ["v"],
        broadcast_rows=None, salt_rows=40,
    )
    assert ours.count() == brute.count()
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_size_check(spark):
    assert fits_for_broadcast(spark.range(10), 10, 1000)
    assert not fits_for_broadcast(spark.range(11), 10, 1000)
    assert not fits_for_broadcast(spark.range(10), 10, 5)
    assert fits_for_broadcast(spark.range(0), 0, 0)
    assert not fits_for_broadcast(spark.range(1000), 10**6, 100)


def test_identical_hot_rows_are_split_and_kept(spark):
    # 5,000 equal right rows of one key: one bucket would hold them all
    right = spark.range(0, 5600).select(
        F.when(F.col("id") < 5000, F.lit(7)).otherwise(F.col("id") % 300).alias("k"),
        F.when(F.col("id") < 5000, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )
    left = spark.range(0, 20).select((F.col("id") % 10).alias("k"))
    plain = left.join(right, "k", "left").groupBy("k", "v").count()
    ours = left_join(left, right.toDF("rk", "v"), [("k", "rk")], broadcast_rows=None, salt_rows=100)
    got = ours.groupBy("k", "v").count()
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    twice = left_join_twice(left.distinct(), right.toDF("rk", "v").where("v = 0 or v > 5500"), [("k", "rk")], ["k"], ["v"], broadcast_rows=None, salt_rows=1000)
    per_key = {r.k: r["count"] for r in right.where("v = 0 or v > 5500").groupBy("k").count().collect()}
    assert twice.count() == sum(per_key.get(k, 1) ** 2 for k in range(10))


def test_expansion_is_exact_on_both_sides_of_a_chunk(spark, monkeypatch):
    from placeseek.operators import joins

    monkeypatch.setattr(joins, "EXPAND_ROWS", 4)
    df = spark.createDataFrame([(i, i) for i in (1, 2, 3, 4, 5, 8, 9, 40)], "id long, n long")
    assert {r.id: r["count"] for r in joins.expand(df, "n").groupBy("id").count().collect()} == {i: i for i in (1, 2, 3, 4, 5, 8, 9, 40)}


def test_small_left_branch_matches_brute_force(spark):
    left, right = _hot_tables(spark)  # 150 left rows, 900 right rows
    left.createOrReplaceTempView("l_hot2")
    right.createOrReplaceTempView("r_hot2")
    once = spark.sql("SELECT l.k, l.w, r.k AS rk, r.v FROM l_hot2 l LEFT JOIN r_hot2 r ON l.k = r.k")
    ours = left_join(left, right.withColumnRenamed("k", "rk"), [("k", "rk")], broadcast_rows=500)
    assert ours.columns == ["k", "w", "rk", "v"]
    assert ours.count() == once.count() and ours.exceptAll(once).count() == 0
    brute = spark.sql(
        "SELECT c.k, c.w, s.v FROM (SELECT l.*, r.v AS v1 FROM l_hot2 l LEFT JOIN r_hot2 r ON l.k = r.k) c "
        "LEFT JOIN r_hot2 s ON c.k = s.k"
    )
    twice = left_join_twice(
        left, right.withColumnRenamed("k", "rk"), [("k", "rk")], ["k", "w"], ["v"], broadcast_rows=500
    )
    assert twice.count() == brute.count()
    assert twice.exceptAll(brute).count() == 0 and brute.exceptAll(twice).count() == 0


def test_deep_pages_match_a_full_sort(spark):
    from placeseek.operators import page_of_rows

    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.col("id"))
    full = [r.k for r in df.orderBy("k").collect()]
    for page, size in [(1, 7), (3, 1000), (5, 1000), (6, 1000), (7, 999), (1, 5000)]:
        got = [r.k for r in page_of_rows(df, page, size, ["k"], topk_rows=0).collect()]
        assert got == full[(page - 1) * size : page * size], (page, size)


def test_expansion_of_one_hot_row_is_spread(spark):
    from placeseek.operators.joins import EXPAND_ROWS, expand

    rows = spark.createDataFrame([(1, 1_000_000), (2, 1), (3, EXPAND_ROWS), (4, EXPAND_ROWS + 1), (5, 0)], "id int, k long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = expand(rows, "k")
        per = out.groupBy("id", F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total = {i: sum(r["count"] for r in per if r.id == i) for i in range(1, 6)}
    assert total == {1: 1_000_000, 2: 1, 3: EXPAND_ROWS, 4: EXPAND_ROWS + 1, 5: 1}
    hot = [r["count"] for r in per if r.id == 1]
    assert len(hot) == 8 and max(hot) < 250_000
    small = expand(rows.where("k <= 10"), "k", some_large=False)
    assert sorted(r.id for r in small.collect()) == [2, 5] and small.columns == ["id"]
