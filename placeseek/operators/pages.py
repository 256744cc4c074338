"""Stored pages (LIM2): a table sorted once, from which any page reads one or two files.

``store_pages`` range-sorts a table over all its columns (``order_by`` first), writes each range as
a folder of its own with every row's number in it, and next to it a small
table of the ranges: rows, rows before, first and last key.  A page is then a literal
condition on folder and row number, and only the folders that hold it are listed and read.  A cursor (the key of the last
row seen) finds its range by the stored bounds and goes on from there, however deep.

A task sorts ``SORT_ROWS`` rows and cuts them into ranges, so the rows sampled for the sort and
the tasks follow the rows, not the number of ranges.  Equal rows may lie in two ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

#: Rows of a range, on average; a page of the usual size touches one or two.
RANGE_ROWS = 1_000_000
#: Ranges, at most.
MAX_RANGES = 10_000
#: Rows that a task sorts, on average, where ranges are smaller than that.
SORT_ROWS = 500_000
_RANGE, _ROW = "_range", "_row"


@dataclass(frozen=True)
class StoredPages:
    """A sorted table at ``path``; ``order_by`` is its key, ``schema`` the table's own columns."""

    path: str
    order_by: tuple[str, ...]
    schema: StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def _stored_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(_ROW, LongType()), StructField(_RANGE, IntegerType())])

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._stored_schema).parquet(f"{self.path}/rows")

    def rows_of(self, spark: SparkSession, ranges: Sequence[int]) -> DataFrame:
        """``rows`` of the folders of ``ranges`` (one at least); the others are not even listed."""
        reader = spark.read.schema(self._stored_schema).option("basePath", f"{self.path}/rows")
        return reader.parquet(*[f"{self.path}/rows/{_RANGE}={r}" for r in ranges])

    def ranges(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/ranges")

    @property
    def total_order(self) -> list[str]:
        return [*self.order_by, *[c for c in self.columns if c not in self.order_by]]


def store_pages(df: DataFrame, path: str, order_by: Sequence[str] | None = None, range_rows: int = RANGE_ROWS) -> StoredPages:
    """Sort ``df`` by ``order_by`` (ascending, nulls first; all columns by default) and store it at ``path``."""
    pages = StoredPages(path, tuple(order_by or df.columns), df.schema)
    n = df.count()
    ranges = max(1, min(MAX_RANGES, -(-n // range_rows)))
    order = [F.col(f"`{c}`") for c in pages.total_order]
    tasks = min(ranges, max(df.sparkSession.sparkContext.defaultParallelism, -(-n // SORT_ROWS)))
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # monotonically_increasing_id = partition id << 33 | row number in partition
    row = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    ranged = ranged.withColumn(_ROW, row).withColumn(_RANGE, F.spark_partition_id())
    if tasks < ranges:
        # a task's rows are cut at every range_rows; its last range may be short, so a range for each task is kept back
        per_range = max(range_rows, -(-n // (MAX_RANGES - tasks)))
        ranged = ranged.withColumn(_RANGE, (F.col(_RANGE) * MAX_RANGES + F.floor(F.col(_ROW) / per_range)).cast("int"))
        ranged = ranged.withColumn(_ROW, F.col(_ROW) % per_range)
    ranged.write.partitionBy(_RANGE).parquet(f"{path}/rows")

    key = F.struct(*[f"`{c}`" for c in pages.order_by])
    bounds = pages.rows(df.sparkSession).groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )
    # one row per range, MAX_RANGES at most
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    bounds.coalesce(1).write.parquet(f"{path}/ranges")
    return pages


def _picked(spark: SparkSession, pages: StoredPages, ranges: Sequence[int], condition: Column) -> DataFrame:
    if not ranges:
        return spark.createDataFrame([], pages.schema)
    return pages.rows_of(spark, ranges).where(condition).select(*[f"`{c}`" for c in pages.columns])


def stored_page(spark: SparkSession, pages: StoredPages, page: int, size: int) -> DataFrame:
    """Rows ``(page-1)*size`` to ``page*size - 1``, in order.  Reads the ranges that hold them only."""
    if page < 1 or size < 0:
        raise ValueError("page starts at 1 and size must not be negative")
    start, end = (page - 1) * size, page * size
    held = pages.ranges(spark).where((F.col("before") < end) & (F.col("before") + F.col("rows") > start))
    # the ranges of one page: few rows, MAX_RANGES at most
    condition, held = F.lit(False), held.select(_RANGE, "before", "rows").collect()
    for r in held:
        own = F.col(_RANGE) == r[_RANGE]
        if start > r["before"]:
            own &= F.col(_ROW) >= start - r["before"]
        if end < r["before"] + r["rows"]:
            own &= F.col(_ROW) < end - r["before"]
        condition |= own
    return _picked(spark, pages, [r[_RANGE] for r in held], condition).orderBy(*[F.col(f"`{c}`") for c in pages.total_order])


def rows_after(spark: SparkSession, pages: StoredPages, cursor: Sequence[Any], size: int) -> DataFrame:
    """The next ``size`` rows after the key ``cursor`` (the values of ``order_by`` of the last row seen),
    in order.  Rows with that very key count as seen, so the key should be unique among the rows (add columns to ``order_by`` until it is).

    Reads the range in which the cursor lies and as many after it as hold ``size`` rows.
    """
    if len(cursor) != len(pages.order_by):
        raise ValueError(f"the cursor needs a value for each of {', '.join(pages.order_by)}")
    types = {f.name: f.dataType for f in pages.schema.fields}
    at = F.struct(*[F.lit(v).cast(types[c]).alias(c) for v, c in zip(cursor, pages.order_by)])
    left = pages.ranges(spark).where(F.col("last_key") > at).select(_RANGE, "rows", (F.col("first_key") > at).alias("whole"))
    # only the first of these ranges can hold rows up to the cursor; it counts for none
    certain = F.sum(F.when(F.col("whole"), F.col("rows")).otherwise(0)).over(
        Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    )
    needed = left.withColumn("_certain", F.coalesce(certain, F.lit(0))).where(F.col("_certain") < size)
    ids = [r[0] for r in needed.select(_RANGE).collect()]  # MAX_RANGES at most
    order = [F.col(f"`{c}`") for c in pages.total_order]
    key = F.struct(*[F.col(f"`{c}`") for c in pages.order_by])
    return _picked(spark, pages, ids, F.col(_RANGE).isin(ids) & (key > at)).orderBy(*order).limit(size)
