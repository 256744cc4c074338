"""What several operators share: reading tables, scratch tables, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from placeseek.session import scratch_path, ship_package

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: what follows reads files every executor can see, so a
    lost executor costs the tasks in flight and no more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(step, schema)


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of at most ``rows`` rows: bounds what a worker holds."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def run_starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """First rows of the runs of equal values in the first ``keys`` columns."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for i in range(keys):
        c = batch.column(i).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut anew so that no run of equal keys is split (a run is
    one tile, of bounded size)."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None and rest.num_rows:
            batch = pa.concat_batches([rest, batch])
        if not batch.num_rows:
            continue
        last = int(run_starts(batch, keys)[-1])
        if last:
            yield batch.slice(0, last)
        rest = batch.slice(last)
    if rest is not None and rest.num_rows:
        yield rest
