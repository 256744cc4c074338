"""Projections (PRJ1-PRJ7)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ1: rename many columns in one projection.

    A name that is not in ``df`` is ignored; names match without regard to
    case (Spark's default resolution), so ``Tipo -> tipo`` works.
    """
    lower = {c.lower(): c for c in df.columns}
    present = {lower[o.lower()]: n for o, n in mapping.items() if o.lower() in lower}
    return df.withColumnsRenamed(present) if present else df


def select_aliased(df: DataFrame, alias: str, exprs: Mapping[str, Column | str]) -> DataFrame:
    """PRJ2-PRJ4: project through a table alias, naming every output.

    ``exprs`` maps output name to a column of the aliased table (``"c.x"``)
    or to an expression.
    """
    t = df.alias(alias)
    return t.select(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in exprs.items()])


def with_columns(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """PRJ5: add derived columns in one projection."""
    return df.withColumns(dict(cols))


def with_search_parameter(df: DataFrame, text: str | None, name: str = "parameter") -> DataFrame:
    """PRJ6: a constant column holding the user's search text."""
    return df.withColumn(name, F.lit(text).cast("string"))


# The search result record (7 fields) and the workbook column
# each field is filled from.  ``tipo`` is filled (the reference leaves it
# null by mistake); a null ``linha`` stays null.
RECORD_FIELDS = {
    "linha": "linha",
    "municipios": "municipio",
    "tipo": "tipo",
    "h": "h",
    "cep": "cep",
    "paisSKU": "sku_pais",
    "municipioSKU": "sku_municipio",
}


def to_city_record(df: DataFrame, fields: Mapping[str, str] = RECORD_FIELDS) -> DataFrame:
    """PRJ7: map workbook rows to the 7-field search record with a select."""
    return df.select(
        F.col(fields["linha"]).cast("int").alias("linha"),
        *[F.col(src).cast("string").alias(dst) for dst, src in fields.items() if dst != "linha"],
    )
