"""Joins (JON1, JON2, FLT3, FLT4).

Every join takes its keys as ``(left_column, right_column)`` pairs, which
are AND-ed (FLT4) and compared with ``=`` (FLT3: a null key never matches).

* A right side that one aggregate has measured as small (``is_small``) is
  broadcast: the left side streams past it without a shuffle, hot keys or not.
* Else a left side measured as small is broadcast to the *inner* join (an outer
  join cannot broadcast the side it preserves), and the left rows whose key the
  right side lacks are added: those keys come from the right side's key
  columns streamed past the same broadcast.  The large side is never shuffled.
* Otherwise both sides shuffle on the keys.  Adaptive execution splits a hot
  left key.  For hot right keys, the rows per right key are counted first (a
  partial aggregate, written once to the shared folder).  Right rows of keys
  with more than ``salt_rows`` rows are collapsed to distinct rows with their
  multiplicity, dealt into buckets by a hash of the row, met by one copy of the
  left rows per bucket, and expanded again after the join in bounded steps; so
  neither many different nor many equal rows of one key meet in one task.

All forms give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeseek.session import fits_for_broadcast, stored

KeyPairs = Sequence[tuple[str, str]]

# Largest side that is broadcast after a size check (rows, and bytes of its
# values).  Only the join keys and carried columns of that side count.
DEFAULT_BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024
# Rows of one right key that one task may take before the key is salted.
SALT_ROWS = 1_000_000
# Rows that one expansion step makes of a row, at most.
EXPAND_ROWS = 4096


def is_small(df: DataFrame, max_rows: int | None) -> bool:
    """The size proof a broadcast needs: at most ``max_rows`` rows and
    ``BROADCAST_BYTES`` of values.  A stream has no size: never small."""
    if not max_rows or df.isStreaming:
        return False
    return fits_for_broadcast(df, max_rows, BROADCAST_BYTES)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def key_counts(right: DataFrame, rkeys: Sequence[str], name: str = "_k") -> DataFrame:
    """Rows per key of ``right`` (null keys left out: they never match)."""
    keyed = right.where(_all([F.col(k).isNotNull() for k in rkeys]))
    return keyed.groupBy(*rkeys).agg(F.count(F.lit(1)).alias(name))


def expand(df: DataFrame, times: str, some_large: bool = True) -> DataFrame:
    """Each row ``times`` times (at least once), the column dropped.

    Up to ``EXPAND_ROWS`` times a row is expanded in place.  A row of more is first cut into chunks of that size,
    which are dealt to all tasks by a hash of row and chunk and expanded there, so neither an
    array nor a task's output grows with one row's count.  ``some_large=False`` says that no row is that large.
    """
    repeated = lambda rows, n: rows.withColumn("_rep", F.explode(F.array_repeat(F.lit(True), n))).drop("_rep", times)
    count = F.greatest(F.col(times), F.lit(1))
    if not some_large:
        return repeated(df, count.cast("int"))
    usual = repeated(df.where(count <= EXPAND_ROWS), F.least(count, F.lit(EXPAND_ROWS)).cast("int"))
    large = df.where(F.col(times) > EXPAND_ROWS)
    chunks = F.ceil(F.col(times) / EXPAND_ROWS).cast("long")
    large = large.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    large = large.repartition(*[F.col(f"`{f.name}`") for f in large.schema.fields if "map<" not in f.dataType.simpleString()])
    in_chunk = F.least(F.lit(EXPAND_ROWS), F.col(times) - F.col("_chunk") * EXPAND_ROWS).cast("int")
    return usual.union(repeated(large, in_chunk).drop("_chunk"))


class _Sides:
    """Both sides under names of our own, so that clashing names and a shared
    origin of the two tables cannot confuse the join."""

    def __init__(self, left: DataFrame, right: DataFrame, on: KeyPairs):
        self.names = [*left.columns, *right.columns]
        self.lcols = [f"_l{i}" for i in range(len(left.columns))]
        self.rcols = [f"_r{i}" for i in range(len(right.columns))]
        self.types = [f.dataType for f in right.schema.fields]
        at = lambda columns, name: columns.index(name) if name in columns else [c.lower() for c in columns].index(name.lower())
        self.lkeys = [self.lcols[at(left.columns, a)] for a, _ in on]
        self.rkeys = [self.rcols[at(right.columns, b)] for _, b in on]
        self.left, self.right = left.toDF(*self.lcols), right.toDF(*self.rcols)
        self.match = _all([F.col(a) == F.col(b) for a, b in zip(self.lkeys, self.rkeys)])

    def unmatched(self, keys: DataFrame) -> DataFrame:
        """Left rows whose key is not in ``keys`` (distinct right keys), right columns null."""
        rows = self.left.join(keys, self.match, "left_anti")
        return rows.select(*self.lcols, *[F.lit(None).cast(t).alias(c) for c, t in zip(self.rcols, self.types)])


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: KeyPairs,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    salt_rows: int = SALT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """JON1: left outer equi-join on one or more key pairs.

    Output: all left columns, then all right columns; unmatched left rows
    carry nulls on the right.  ``counts`` passes ``key_counts`` of the right side where
    the caller has them already.
    """
    if is_small(right, broadcast_rows):
        s = _Sides(left, right, on)
        return s.left.join(F.broadcast(s.right), s.match, "left").toDF(*s.names)
    s = _Sides(left, right, on)
    if is_small(left, broadcast_rows):
        small = F.broadcast(s.left)
        matched = s.right.join(small, s.match).select(*s.lcols, *s.rcols)
        wanted = F.broadcast(s.left.select(*s.lkeys).distinct())
        keys = s.right.select(*s.rkeys).join(wanted, s.match, "left_semi").distinct()
        # at most the keys of the small left side
        return matched.union(s.unmatched(F.broadcast(keys))).toDF(*s.names)
    if left.isStreaming or right.isStreaming:
        return s.left.join(s.right.hint("merge"), s.match, "left").toDF(*s.names)
    rkeys = [b for _, b in on]
    if counts is None:
        counts = stored(key_counts(right, rkeys), "key-counts")
    hot = counts.where(F.col("_k") > salt_rows).select(
        *[F.col(b).alias(f"_h{i}") for i, b in enumerate(rkeys)], F.ceil(F.col("_k") / salt_rows).cast("int").alias("_buckets")
    )
    if hot.isEmpty():
        return s.left.join(s.right.hint("merge"), s.match, "left").toDF(*s.names)
    is_hot_right = _all([F.col(k) == F.col(f"_h{i}") for i, k in enumerate(s.rkeys)])
    is_hot_left = _all([F.col(k) == F.col(f"_h{i}") for i, k in enumerate(s.lkeys)])
    # plain keys: as ever, on what is left of both sides
    plain = s.left.join(hot, is_hot_left, "left_anti").join(
        s.right.join(hot, is_hot_right, "left_anti").hint("merge"), s.match, "left"
    )
    # hot keys: equal rows collapse in the map tasks already
    rows = s.right.join(hot, is_hot_right).groupBy(*s.rcols, "_buckets").agg(F.count(F.lit(1)).alias("_times"))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*s.rcols), F.col("_buckets")).cast("int"))
    copies = s.left.join(hot, is_hot_left).withColumn("_lsalt", F.explode(F.sequence(F.lit(0), F.col("_buckets") - 1)))
    met = copies.join(rows.drop("_buckets").hint("merge"), s.match & (F.col("_lsalt") == F.col("_salt")))
    return plain.union(expand(met.select(*s.lcols, *s.rcols, "_times"), "_times")).toDF(*s.names)


def left_join_twice(
    left: DataFrame,
    right: DataFrame,
    on: KeyPairs,
    left_cols: Sequence[str],
    right_cols: Sequence[str],
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """JON2: the reference's "join, then LEFT JOIN the same table again".

    ``SELECT c.<left_cols>, s.<right_cols> FROM (left LEFT JOIN right) c
    LEFT JOIN right s ON <same keys>``: a left row with k matches comes out
    k * k times (each of its k matched rows k times), an unmatched row once.
    That size is the query's definition; ``plans.enrich.enrich_cities``
    joins once and is the form to use when keys repeat.

    The right side is counted per key once (written to the shared folder).  The
    left rows take their k from these counts, are joined to the right side once, and
    every row is then expanded k times.
    """
    rkeys = [b for _, b in on]
    keys = [f"_key{i}" for i in range(len(on))]
    carried = right.select(*rkeys, *[c for c in right_cols if c not in rkeys])
    counts = stored(key_counts(carried, rkeys), "key-counts")
    per_key = [(a, k) for (a, _), k in zip(on, keys)]
    with_k = left_join(left, counts.toDF(*keys, "_k"), per_key, broadcast_rows, salt_rows)
    with_k = with_k.select(*left.columns, F.coalesce("_k", F.lit(1).cast("long")).alias("_k"))
    joined = left_join(with_k, carried, on, broadcast_rows, salt_rows, counts)
    width = len(left.columns)
    names = [f"_o{i}" for i in range(len(joined.columns))]
    joined = joined.toDF(*names)
    of_left = [names[left.columns.index(c)] for c in left_cols]
    of_right = [names[width + 1 + carried.columns.index(c)] for c in right_cols]
    chosen = joined.select(*[F.col(n).alias(f"_c{i}") for i, n in enumerate([*of_left, *of_right])], F.col(names[width]).alias("_k"))
    some_large = not counts.where(F.col("_k") > EXPAND_ROWS).isEmpty()
    return expand(chosen, "_k", some_large).toDF(*left_cols, *right_cols)
