"""Connected components of a table of links (operators 1 and 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import stored


def _starred(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with each u's smallest v, or u itself, as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("m", "u").alias("m")), "u")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component_id`` (the smallest id reachable) of every id that
    has a link to another; links may repeat and run either way.

    Alternates large-star and small-star steps, which replace links by links to
    smaller ids without parting a component, until every link leads from an id to the
    smallest of its component.  Minima are partial aggregates and links meet them in a
    plain shuffle join, so a hub's links are never gathered in one row; each round is
    written to the shared folder.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stored(edges.distinct(), "links")
    while not _is_settled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _starred(_starred(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))
        small = near.select("u", F.col("m").alias("v")).union(near.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.where("u != v").distinct(), "links")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)


def _is_settled(edges: DataFrame) -> bool:
    """Whether each id has one link up at most and none to an id that has one itself."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    per = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or (up = 1 and down = 1)").isEmpty()
