"""Distinct top rows, stored pages and cursors against plain sorts."""

import random

import pytest
from pyspark.sql import functions as F

from placeseek.operators.aggregate import first_distinct_rows
from placeseek.operators.pages import rows_after, store_pages, stored_page

ROWS = [(random.Random(i).choice([None, "", "a", "b", "é", "Z", "zz"]), random.Random(i).choice([None, 1, 2, 3, -5]), i % 7 == 0) for i in range(3000)]
SCHEMA = "name string, k int, flag boolean"


def _plain(df, n):
    return df.distinct().orderBy(*df.columns).limit(n).collect()


@pytest.mark.parametrize("n", [0, 1, 3, 10, 500])
def test_first_distinct_rows(spark, n):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    assert first_distinct_rows(df, n).collect() == _plain(df, n)
    assert first_distinct_rows(df, n, ["k"]).collect() == _plain(df.select("k"), n)


def test_first_distinct_rows_of_other_types_and_tables(spark):
    df = spark.createDataFrame([(0.0, "x"), (-0.0, "x"), (float("nan"), "x"), (None, "y")] * 3, "v double, s string")
    assert str(first_distinct_rows(df, 5).collect()) == str(_plain(df, 5))
    times = df.select(F.lit("2024-01-01 10:00:00").cast("timestamp").alias("t"), F.lit("7.10").cast("decimal(9,2)").alias("d"), F.lit(b"a").alias("b"))
    assert first_distinct_rows(times, 5).collect() == _plain(times, 5)
    assert first_distinct_rows(df.select("s").limit(0), 5).count() == 0
    clashing = df.select(F.col("s"), F.col("s").alias("S"), F.upper("s").alias("s"))
    assert [tuple(r) for r in first_distinct_rows(clashing, 5).collect()] == [("x", "x", "X"), ("y", "y", "Y")]


def test_only_n_rows_per_task_are_shuffled(spark):
    df = spark.range(0, 100_000, numPartitions=8).select(F.xxhash64("id").alias("h"))
    seen = first_distinct_rows(df, 10)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    # the aggregate and its exchange stand above the operator that keeps ten rows
    assert plan.index("MapInArrow") > plan.index("Exchange hashpartitioning")
    from placeseek.operators.aggregate import _first_of_task

    passed = df.toDF("_c0").mapInArrow(_first_of_task(["_c0"], 10), "_c0 long").groupBy(F.spark_partition_id()).count().collect()
    assert len(passed) == 8 and {r[1] for r in passed} == {10}


@pytest.fixture()
def pages(spark, tmp_dir):
    rnd = random.Random(9)
    rows = [(rnd.choice([None, "a", "b", "c"]), i, rnd.random()) for i in range(1000)] + [("b", 5000, 0.5)] * 40
    df = spark.createDataFrame(rows, "grp string, id int, v double").repartition(3)
    return df, store_pages(df, tmp_dir + "/pages", ["grp", "id"], range_rows=100)


def test_every_page(spark, pages):
    df, stored = pages
    want = [tuple(r) for r in df.orderBy("grp", "id", "v").collect()]
    got = []
    for page in range(1, 17):
        rows = [tuple(r) for r in stored_page(spark, stored, page, 70).collect()]
        assert rows == want[(page - 1) * 70 : page * 70]
        got += rows
    assert got == want
    assert stored_page(spark, stored, 1, 0).count() == 0 and stored_page(spark, stored, 99, 70).count() == 0
    assert stored_page(spark, stored, 1, 5000).count() == len(want)
    with pytest.raises(ValueError):
        stored_page(spark, stored, 0, 5)


def test_a_page_reads_one_or_two_files(spark, pages):
    _, stored = pages
    assert len(stored.rows(spark).inputFiles()) >= 10
    second = stored_page(spark, stored, 2, 20)
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan.split("PartitionFilters:")[1].split("]")[0]
    read = spark.read.parquet(stored.path + "/rows").where(F.input_file_name().isNotNull())
    files = {r[0] for r in stored_page_files(spark, stored, 2, 20, read)}
    assert 1 <= len(files) <= 2


def stored_page_files(spark, stored, page, size, read):
    start, end = (page - 1) * size, page * size
    held = stored.ranges(spark).where((F.col("before") < end) & (F.col("before") + F.col("rows") > start))
    ids = [r[0] for r in held.select("_range").collect()]
    return read.where(F.col("_range").isin(ids)).select(F.input_file_name()).distinct().collect()


def test_cursor_walks_the_whole_table(spark, tmp_dir):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "b", "é"]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "grp string, id int").repartition(3)
    stored = store_pages(df, tmp_dir + "/pages", range_rows=90)
    want = [tuple(r) for r in df.orderBy("grp", "id").collect()]
    got = [tuple(r) for r in stored_page(spark, stored, 1, 130).collect()]
    while len(got) < len(want):
        more = [tuple(r) for r in rows_after(spark, stored, got[-1], 130).collect()]
        assert more == want[len(got) : len(got) + 130]
        got += more
    assert rows_after(spark, stored, got[-1], 10).count() == 0
    assert [tuple(r) for r in rows_after(spark, stored, ("a", -1), 1).collect()] == [next(r for r in want if r[0] == "a")]
    with pytest.raises(ValueError):
        rows_after(spark, stored, ("a",), 1)


def test_empty_table_and_clashing_names(spark, tmp_dir):
    df = spark.createDataFrame([], "a int")
    stored = store_pages(df, tmp_dir + "/empty")
    assert stored_page(spark, stored, 1, 10).count() == rows_after(spark, stored, (1,), 5).count() == 0
    odd = spark.createDataFrame([(2, "x"), (1, "y")], "`a b` int, `rows` string")
    stored = store_pages(odd, tmp_dir + "/odd", ["a b"])
    assert [tuple(r) for r in stored_page(spark, stored, 1, 10).collect()] == [(1, "y"), (2, "x")]


def test_sort_tasks_follow_the_rows_not_the_ranges(spark, tmp_dir, monkeypatch):
    """The rows sampled for the sort, the tasks and the listing of a page do not grow with the number of ranges."""
    from placeseek.operators import pages as module

    asked = []
    plain = type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda self, n, *c: (asked.append(n), plain(self, n, *c))[1])
    monkeypatch.setattr(module, "MAX_RANGES", 200)
    df = spark.range(3000).select((F.col("id") % 7).alias("grp"), F.expr("IF(id < 1000, 5, id)").alias("k"), F.lit("x").alias("v"))
    stored = store_pages(df, tmp_dir + "/pages", ["grp", "k"], range_rows=10)
    parallel = spark.sparkContext.defaultParallelism
    assert asked == [parallel]
    sizes = [r["rows"] for r in stored.ranges(spark).collect()]
    assert sum(sizes) == 3000 and len(sizes) <= 200 and max(sizes) <= -(-3000 // (200 - parallel))
    want = [tuple(r) for r in df.orderBy("grp", "k", "v").collect()]
    second = stored_page(spark, stored, 12, 25)
    assert [tuple(r) for r in second.collect()] == want[275:300]
    assert len(second.inputFiles()) <= 4 < len(stored.rows(spark).inputFiles())  # not even listed
    after = [tuple(r) for r in rows_after(spark, stored, (5, 2991), 40).collect()]
    assert after == [r for r in want if r[:2] > (5, 2991)][:40]
