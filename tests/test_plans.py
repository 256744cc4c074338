"""Plan shapes the scale design depends on (checked on sf0.001 tables)."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from placeseek.operators import left_join, page_of_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    return plan_of(df)


def test_enrichment_streams_cities_past_a_broadcast(spark):
    plan = plan_of(entry.queries()["enrich_cities"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "Exchange hashpartitioning" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["left_join_two_keys"](spark, SF_SMALL))
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan
    assert "o_totalprice" not in plan


def test_search_stays_in_the_jvm(spark):
    for name in ("fuzzy_documents", "fuzzy_search", "phonetic_match", "soundex_codes", "sql_udf_call"):
        plan = plan_of(entry.queries()[name](spark, SF_SMALL))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
    fuzzy = plan_of(entry.queries()["fuzzy_documents"](spark, SF_SMALL))
    assert "levenshtein(" in fuzzy and "Some(2)" in fuzzy  # the bounded form
    assert "from_json" not in fuzzy  # the terms are one constant
    assert fuzzy.count("Exchange") <= 1  # the distinct reuses the rebalancing shuffle


def test_hot_right_keys_are_salted(spark):
    left = spark.range(0, 100).select(F.col("id").alias("k"))
    right = spark.range(0, 1000).select((F.col("id") % 3).alias("rk"), F.col("id").alias("v"))
    joined = left_join(left, right, [("k", "rk")], broadcast_rows=None, salt_rows=50)
    plan = plan_of(joined)
    assert "_salt" in plan and "SortMergeJoin" in plan
    assert joined.count() == 1000 + 97


def test_unchecked_sides_are_not_broadcast(spark):
    left = spark.range(0, 100).select(F.col("id").alias("k"))
    right = spark.range(0, 100).select(F.col("id").alias("rk"))
    plan = plan_of(left_join(left, right, [("k", "rk")], broadcast_rows=None))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_deep_pages_do_not_depend_on_exchange_reuse(spark):
    df = spark.range(0, 20_000, 1, 6).select(((F.col("id") * 7919) % 20_000).alias("k"))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            for page in (2, 7, 13, 20):
                got = [r.k for r in page_of_rows(df, page, 1000, ["k"], topk_rows=0).collect()]
                assert got == list(range((page - 1) * 1000, page * 1000)), (reuse, page)
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")


def test_small_left_side_never_moves_the_large_one(spark):
    left = spark.range(0, 50).select((F.col("id") * 7).alias("k"))
    right = spark.range(0, 100_000).select(F.col("id").alias("rk"), (F.col("id") % 5).alias("v"))
    joined = left_join(left, right, [("k", "rk")], broadcast_rows=1000)
    assert sorted(r.k for r in joined.collect()) == [i * 7 for i in range(50)]
    plan = plan_of(joined)
    # the large side streams past broadcasts; what is exchanged are distinct keys
    assert "Inner, BuildRight" in plan and "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    assert "_r1" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_size_proof_is_one_job(spark):
    from placeseek.session import fits_for_broadcast, spread

    right = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("size-proof", "x")
    try:
        assert fits_for_broadcast(right, 500_000, 1 << 28)
        assert len(tracker.getJobIdsForGroup("size-proof")) <= 2  # adaptive: one job per stage
        spark.sparkContext.setJobGroup("spread", "x")
        spread(right.distinct(), "o_orderkey")
        assert not tracker.getJobIdsForGroup("spread")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_salted_double_join_has_no_window(spark):
    from placeseek.operators import left_join_twice

    left = spark.range(0, 100).select(F.col("id").alias("k"))
    right = spark.range(0, 1000).select((F.col("id") % 3).alias("rk"), F.col("id").alias("v"))
    joined = left_join_twice(left, right, [("k", "rk")], ["k"], ["v"], broadcast_rows=None, salt_rows=50)
    plan = plan_of(joined)
    assert "Window" not in plan and "_salt" in plan
    # keys 0..2 each have 333-334 rows: k * k rows per key, one row per unmatched key
    assert joined.count() == 334 * 334 + 333 * 333 * 2 + 97


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    import pytest

    from placeseek import session

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="share"):
        session.checkpoint_root(Session)
