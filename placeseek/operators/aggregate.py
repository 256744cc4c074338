"""Aggregations (AGG1, AGG2)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.session import ship_package

# Types whose order and equality are the same in Arrow and in Spark.
_SAME_ORDER = re.compile(r"string|boolean|tinyint|smallint|int|bigint|date|timestamp|timestamp_ntz|binary|decimal\(.*\)")


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """AGG1: one row with the number of rows of ``df``.

    A global aggregate: each task counts its rows, one tiny final merge.
    """
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG2: distinct rows over ``cols`` (all columns when omitted).

    Planned as a partial hash aggregate before the shuffle and a final one
    after it, so duplicates (however many share one value) combine map-side.
    """
    return (df.select(*cols) if cols else df).distinct()


def first_distinct_rows(df: DataFrame, n: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG2 + LIM1: the first ``n`` distinct rows over ``cols``, in their order (ascending, nulls first).

    ``distinct`` alone would shuffle every distinct row to keep ten of them.  A row among the first ``n`` of all
    is among the first ``n`` of its task, so each task passes on its ``n`` smallest distinct rows and no
    more; the distinct rows of those are few.  Columns of other types (floating point, nested)
    take the plain form.
    """
    rows = df.select(*cols) if cols else df
    names = [f"_c{i}" for i in range(len(rows.columns))]
    if n > 0 and all(_SAME_ORDER.fullmatch(f.dataType.simpleString()) for f in rows.schema.fields):
        ship_package(df.sparkSession)
        renamed = rows.toDF(*names)
        rows = renamed.mapInArrow(_first_of_task(names, n), renamed.schema).toDF(*rows.columns)
    return rows.distinct().toDF(*names).orderBy(*names).limit(n).toDF(*rows.columns)


def _first_of_task(names: Sequence[str], n: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                last = held.column(0)[-1]
                if len(held) == n and last.is_valid:  # a row that begins with more is beyond the n held
                    begins = rows.column(0)
                    rows = rows.filter(pc.or_kleene(pc.less_equal(begins, last), pc.is_null(begins)))
                rows = pa.concat_tables([held, rows])
            rows = rows.group_by(list(names), use_threads=False).aggregate([])
            order = pc.sort_indices(rows, [(c, "ascending") for c in names], null_placement="at_start")
            held = rows.take(order[:n]).combine_chunks()
        if held is not None:
            yield from held.select(list(names)).to_batches()

    return step
