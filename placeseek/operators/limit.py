"""Ordered limits and pages (LIM1, LIM2, SNK3).

The reference takes ten rows of an unordered result; here a total order is
always given first, so the same rows come back on every run.  An ordered
limit is planned as a per-partition top-k plus a merge of at most
``k * partitions`` rows, never a full sort of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.session import stored

# Pages ending past this many rows are cut out of a distributed sort
# instead of a per-partition top-k (whose merge grows with the page end).
DEEP_PAGE_ROWS = 10_000


def _order(df: DataFrame, order_by: Sequence[str | Column] | None) -> list[str | Column]:
    return list(order_by) if order_by else list(df.columns)


def first_rows(df: DataFrame, n: int = 10, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """LIM1/SNK3: the first ``n`` rows in a total order (all columns by default)."""
    return df.orderBy(*_order(df, order_by)).limit(n)


def page_of_rows(
    df: DataFrame,
    page: int,
    size: int,
    order_by: Sequence[str | Column] | None = None,
    topk_rows: int = DEEP_PAGE_ROWS,
) -> DataFrame:
    """LIM2: rows ``(page-1)*size`` to ``page*size - 1`` in a total order.

    A page ending within ``topk_rows`` is a per-partition top-k.  A deeper
    page is cut from a range-partitioned sort, which is written once to the shared folder
    with each row's partition and place in it.  Counting the partitions and
    picking the rows then read the same files, whatever Spark would have
    sampled the second time.  Each partition's row count gives its first
    global position (one row per partition, summed in order), and each task
    keeps only its rows that fall on the page.
    """
    if page < 1 or size < 0:
        raise ValueError("page starts at 1 and size must not be negative")
    order = _order(df, order_by)
    start, end = (page - 1) * size, page * size
    if end <= topk_rows:
        return df.orderBy(*order).offset(start).limit(size)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = stored(
        ranged.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "page"
    )
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    firsts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    firsts = firsts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    # monotonically_increasing_id = partition id << 33 | row number in partition
    pos = F.col("_first") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    # one row per partition of the sort
    rows = ranged.join(F.broadcast(firsts), "_pid").where((pos >= start) & (pos < end))
    return rows.select(*df.columns).orderBy(*order)
