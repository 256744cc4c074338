"""Vectors as operators 4 and 6 take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector that is not null and holds only finite components."""
    inf = float("inf")
    each = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return vector.isNotNull() & F.coalesce(each, F.lit(False))


def by_id(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``_id`` (not null) and ``_vector`` of the finite vectors, each id once:
    of an id's several vectors the smallest in array order counts."""
    kept = vectors.where(F.col(id_col).isNotNull() & finite(F.col(vector_col)))
    return kept.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(F.col(vector_col).cast("array<double>")).alias("_vector"))
