"""The driver's tables in the reference's shapes.

The reference's own inputs (municipality workbooks, a states CSV) are not
available, so its operators run on stand-ins derived by Spark from the
TPC-H-like tables: ``part`` as country-workbook rows, ``customer`` as
cities, ``nation`` joined to ``region`` as states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.operators.joins import left_join


def part_as_workbook(part: DataFrame) -> DataFrame:
    """``part`` with the 7 renamed country-workbook columns.

    ``sku_pais`` is all null, so the search text skips it (FN2).
    """
    return part.select(
        F.col("p_partkey").cast("int").alias("linha"),
        F.col("p_name").alias("municipio"),
        F.col("p_type").alias("tipo"),
        F.col("p_brand").alias("h"),
        F.col("p_size").cast("string").alias("cep"),
        F.lit(None).cast("string").alias("sku_pais"),
        F.col("p_partkey").cast("string").alias("sku_municipio"),
    )


def states_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nations as states: key, name (``nomeEstado``), region (``continente``)."""
    joined = left_join(nation, region, [("n_regionkey", "r_regionkey")], broadcast_rows=10_000)
    return joined.select(
        "n_nationkey",
        F.col("n_name").alias("nomeEstado"),
        F.col("r_name").alias("continente"),
    )
