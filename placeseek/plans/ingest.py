"""Ingest of new workbooks only (SRC5, SRC2, SNK1).

The manifest is a table of the files read so far (path, length, time of change) with the batch that read each.  A run
anti-joins the folder's listing with it, so it opens new and changed files only.  Its rows are written under
the batch's own folder, and the batch counts once its files are appended to the manifest, in one file: a run that
fails before leaves rows that no reader sees, and the next run reads the same files again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from placeseek.session import stored
from placeseek.sources.excel import read_workbooks

_MANIFEST = "path string, length long, modificationTime timestamp, batch string"
BATCH_COL = "_batch"


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """The files read so far; none before the first run."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{store}/manifest")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def new_files(spark: SparkSession, pattern: str, store: str, suffix: str = ".xlsx") -> DataFrame:
    """Workbooks of ``pattern`` that are not in the manifest as they are now; none is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(pattern)
    listed = listed.select("path", "length", "modificationTime")
    return listed.join(manifest(spark, store), ["path", "length", "modificationTime"], "left_anti")


def ingest_new(
    spark: SparkSession, pattern: str, store: str, schema: StructType, empty_as_null: bool = False, suffix: str = ".xlsx"
) -> int:
    """Append the rows of new workbooks to ``store``; returns how many workbooks there were."""
    batch = uuid.uuid4().hex
    files = stored(new_files(spark, pattern, store, suffix), "new-files")
    n = files.count()
    if n:
        rows = read_workbooks(spark, pattern, schema, empty_as_null, only=files.select("path"))
        rows.write.parquet(f"{store}/rows/{BATCH_COL}={batch}")
        # the commit: one small file, a row per workbook
        files.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return n


def ingested(spark: SparkSession, store: str, schema: StructType) -> DataFrame:
    """All rows of committed batches.  A changed workbook's rows stand once for each form it was read in."""
    batches = [r[0] for r in manifest(spark, store).select("batch").distinct().collect()]  # one per run
    if not batches:
        return spark.createDataFrame([], schema)
    held = spark.read.schema(StructType([*schema.fields, StructField(BATCH_COL, StringType())])).parquet(f"{store}/rows")
    return held.where(F.col(BATCH_COL).isin(batches)).drop(BATCH_COL)
