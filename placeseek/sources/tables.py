"""CSV and view sources (SRC4, SRC7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_strings(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """SRC4: a CSV file (or folder, or glob) with a header, every column text.

    No type inference, so the file is read once.  Empty fields, quoted or
    not, come back null; the text ``NA`` stays ``NA``.
    """
    return spark.read.option("header", header).option("inferSchema", False).csv(path)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """SRC7: ``SELECT * FROM name`` for a registered view or table."""
    return spark.table(name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
