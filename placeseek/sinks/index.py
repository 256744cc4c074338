"""Sinks and actions (SNK1-SNK7).

The reference appends documents to a search index through a connector.
Here the connector is a parameter: any Spark data source that takes a
name or path in ``save`` and options (a search-index connector on a
cluster, ``json`` or ``parquet`` in tests).  Connection values come only
from the caller; nothing is built in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from placeseek.operators.limit import first_rows


def append_to_index(
    df: DataFrame,
    target: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    dedupe_keys: Sequence[str] | None = None,
) -> None:
    """SNK1/SNK2: append ``df`` to ``target`` through the ``fmt`` connector.

    Append semantics, as in the reference: writing twice stores every row
    twice.  With ``dedupe_keys`` one row per key is written instead (a
    distributed drop of duplicates before the write).  Each task writes its
    own partition, so no row passes through the driver.
    """
    out = df.dropDuplicates(list(dedupe_keys)) if dedupe_keys else df
    out.write.format(fmt).options(**dict(options or {})).mode("append").save(target)


def preview_then_append(
    df: DataFrame,
    target: str,
    fmt: str,
    n: int = 10,
    options: Mapping[str, str] | None = None,
    shown: DataFrame | None = None,
) -> list[Row]:
    """SNK3 then SNK1, as the source application runs them: any ``n`` rows (of
    ``shown`` where the preview has another shape), then the append.  The preview
    takes its rows from as few partitions as hold them; nothing is cached."""
    rows = (df if shown is None else shown).take(n)
    append_to_index(df, target, fmt, options)
    return rows


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SNK7: name a relation for SQL; returns ``df`` for chaining."""
    df.createOrReplaceTempView(name)
    return df


def json_lines(df: DataFrame, name: str = "value") -> DataFrame:
    """SNK4: each row as one JSON object; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def write_json_lines(df: DataFrame, path: str) -> None:
    """SNK5, re-aimed: instead of printing rows inside executors, write
    their JSON text, one file per task."""
    json_lines(df).write.mode("append").text(path)


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """SNK3: the first ``n`` rows in a fixed order (call ``.show()`` to print)."""
    return first_rows(df, n, order_by)


def collect_records(df: DataFrame, n: int = 10, order_by: Sequence[str] | None = None) -> list[Row]:
    """SNK6: bring at most ``n`` rows to the driver, never more."""
    return first_rows(df, n, order_by).collect()
