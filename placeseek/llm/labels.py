"""Labelled rows for the two classifiers (operators 2 and 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import stored

#: Labelled rows a model is fitted on, at most (give or take the spread of a
#: hash); scores, counts and thresholds always cover every row.
MAX_TRAINING_ROWS = 16_000
# Fixed value: one row of this many is held out, by crc32 of the id as text.
HELD_OUT_EVERY = 5


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_EVERY == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """``text`` and ``y`` (0 or 1) of labelled rows that are not held out, stored once.

    With more than ``max_rows`` of them, those with the smallest hashes are
    taken.  Ids with several labels count as 1 if any is 1; null labels, other
    labels and null ids are left out.
    """
    known = (
        labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("y"))
    )
    n = known.count()
    if n > max_rows:
        buckets = 1_000_003
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < int(buckets * max_rows / n))
    known = known.select(F.col("doc_id").alias("_id"), "y")
    rows = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("text"))
    # at most max_rows small rows
    rows = rows.join(F.broadcast(known), F.col("_key") == F.col("_id"))
    return stored(rows.select(F.coalesce("text", F.lit("")).alias("text"), "y"), f"training-{target}")
