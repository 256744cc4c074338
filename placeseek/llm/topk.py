"""Operator 6: exact top-k search by inner product over a bit-sliced index.

Components are quantised to whole numbers.  Candidates are dealt into blocks,
and in a block every attribute becomes slices: one bitmap over the block's rows
per bit.  A query's scores are then added up as bitmaps: each set bit of
each query component contributes the attribute's slices (their complement
where the component is negative) at a shifted weight, and carry-save adders
turn three bitmaps of a weight into one of it and one of the next.  From the
score's most significant slice downward the k-th highest value is found by
counting bits.  The lowest ``low_bits`` bits of the attributes are left out
of the slices, so a score is known up to a proven bound; every row within that
bound of the k-th value is a boundary row, and all those are scored exactly.

A grid of candidate blocks and query blocks spreads the work: each tile meets
one block of each, so a task's memory is bounded however many there are.

Defined results: vectors that are null or hold null or non-finite components
take no part; of an id's several vectors the smallest counts; null ids take no
part; shorter vectors count as filled up with zeros; ties go to the smaller id;
fewer than k candidates are all returned; no queries or an empty table give no
rows; a component beyond ``LARGEST`` after quantising stops the job, as scores
could leave the range of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.llm.common import stored
from placeseek.llm.vectors import by_id
from placeseek.session import ship_package

CANDIDATES_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 512
LOW_BITS = 2
LARGEST = 1 << 24


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class BitSlices:
    """The bit-sliced index of one block: ``values`` is rows x attributes, whole numbers."""

    def __init__(self, values: np.ndarray, low_bits: int = LOW_BITS):
        self.rows, self.low = values.shape[0], low_bits
        raised = (values - values.min(axis=0)) >> low_bits
        self.width = max(1, int(raised.max()).bit_length())
        words = -(-self.rows // 64)
        bits = np.zeros((2, values.shape[1], self.width, words * 64), bool)
        for j in range(self.width):
            bits[0, :, j, : self.rows] = (raised.T >> j) & 1
        bits[1] = ~bits[0]
        self.slices = np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)
        inside = np.zeros(words * 64, bool)
        inside[: self.rows] = True
        self.inside = np.packbits(inside, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, lowest first, of the sum of |q| times attribute or its complement."""
        size, negative = np.abs(query), (query < 0).astype(np.int64)
        parts: dict[int, list[np.ndarray]] = {}
        for b in range(int(size.max(initial=0)).bit_length()):
            d = np.flatnonzero((size >> b) & 1)
            if len(d):
                for j in range(self.width):
                    parts.setdefault(b + j, []).append(self.slices[negative[d], d, j])
        out, weight = [], 0
        while parts:
            stack = np.concatenate(parts.pop(weight, [np.zeros((1, len(self.inside)), np.uint64)]))
            while len(stack) > 1:
                if len(stack) == 2:
                    kept, carry = stack[:1] ^ stack[1:], stack[:1] & stack[1:]
                    rest = stack[:0]
                else:
                    third = len(stack) // 3
                    a, b, c, rest = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third], stack[3 * third :]
                    either = a ^ b
                    kept, carry = either ^ c, (a & b) | (either & c)
                parts.setdefault(weight + 1, []).append(carry)
                stack = np.concatenate((kept, rest))
            out.append(stack[0])
            weight += 1
        return out

    def contenders(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Rows among ``allowed`` (a bitmap) that can be among the k highest."""
        sums = self.sums(query)
        count = lambda bitmap: int(np.bitwise_count(bitmap).sum())
        above, even, value = np.zeros_like(allowed), allowed, 0
        for weight in range(len(sums) - 1, -1, -1):
            here = above | (even & sums[weight])
            n = count(here)
            if n >= k:  # the k-th highest has this bit
                even, value = even & sums[weight], value | 1 << weight
                if n == k:
                    break
            else:
                above, even = here, even & ~sums[weight]
        # what was cut off adds at most this much, in units of the lowest slice
        slack = int(np.abs(query).sum()) * ((1 << self.low) - 1) >> self.low
        least = value - slack - 1
        if least <= 0:
            found = allowed
        else:
            above, even = np.zeros_like(allowed), allowed
            for weight in range(max(len(sums), least.bit_length()) - 1, -1, -1):
                bits = sums[weight] if weight < len(sums) else np.zeros_like(allowed)
                if least >> weight & 1:
                    even = even & bits
                else:
                    above, even = above | (even & bits), even & ~bits
            found = above | even
        return np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))


def search_block(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of each query's k best rows of one block."""
    index, out = BitSlices(values), []
    for q, query in zip(query_ids.tolist(), queries):
        allowed = index.inside.copy()
        for row in np.flatnonzero(ids == q).tolist():
            allowed[row // 64] &= ~np.uint64(1 << row % 64)
        rows = index.contenders(query, k, allowed)
        exact = values[rows] @ query
        best = np.lexsort((ids[rows], -exact))[:k]
        out += [(q, int(ids[rows[i]]), int(exact[i])) for i in best]
    return out


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors.to_pylist()):
        row[: len(v)] = v
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k rows with the
    highest integer inner product for each row where ``is_query`` (a condition
    on ``_id``) holds, the query's own row left out."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = by_id(vectors, id_col, vector_col).select("_id", quantised(F.col("_vector"), scale).alias("_q"))
    rows = stored(rows.withColumn("_asks", F.coalesce(is_query, F.lit(False))), "topk-rows")
    size = F.transform("_q", lambda x: F.abs(x))
    n, asking, dims, largest = rows.agg(
        F.count("_id"),
        F.coalesce(F.sum(F.col("_asks").cast("long")), F.lit(0)),
        F.coalesce(F.max(F.size("_q")), F.lit(0)),
        F.coalesce(F.max(F.array_max(size)), F.lit(0)),
    ).first()
    if largest > LARGEST:
        raise ValueError(f"a quantised component of {largest} is beyond {LARGEST}")
    blocks, query_blocks = max(1, -(-n // candidates_per_block)), max(1, -(-asking // queries_per_block))
    deal = lambda m: F.pmod(F.xxhash64("_id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select(deal(blocks).alias("_block"), "_id", "_q", every(query_blocks).alias("_part"))
    queries = rows.where("_asks").select(deal(query_blocks).alias("_part"), "_id", "_q", every(blocks).alias("_block"))
    dims = max(dims, 1)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            found = search_block(
                left["_id"].to_numpy(), _matrix(left["_q"], dims), right["_id"].to_numpy(), _matrix(right["_q"], dims), k
            )
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    found = (
        candidates.groupBy("_block", "_part")
        .cogroup(queries.groupBy("_block", "_part"))
        .applyInArrow(tile, "query_id long, vec_id long, score long")
    )
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
