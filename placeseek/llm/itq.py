"""Operator 4: near-duplicate vectors by iterative quantisation.

Rotations are learned on the driver from a bounded sample of unit vectors:
principal axes of the centred sample, then turns that alternate between the
signs of the rotated sample and the best orthogonal fit to them, so that bits
are balanced and cut few close pairs.  A vector's code is its signs.  Codes are
cut into substrings, and each substring is the key of one Hamming table.  Two
vectors that share the substring of any table are compared by their original
vectors in double precision.

The substring length and the number of tables follow from the number of vectors
and from pairs made at the threshold cosine itself: sample vectors turned towards
other sample vectors, and in random directions.  As codes are taken about the
centre, where vectors with a common direction are further apart than about the
origin, the share of such pairs that agree in a substring is measured, not taken
from the angle.  The length is that of the least work, and tables are added until
``TARGET_RECALL`` of the pairs of either kind meet; closer pairs are missed less.

Equal vectors are one class with a weight, so copies are never paired.  A bucket
of more than ``TILE_ROWS`` vectors is dealt into chunks and compared as tiles of
two chunks, every pair of chunks being a tile, so no task gets a whole bucket.  A
pair found by several tables counts in the first.  A tile gives each row's number
of links and one link per row to the smallest id it is joined to inside the tile,
never the pairs themselves.

Defined results: vectors that are null, zero or hold null or non-finite
components link with nothing; a pair of different lengths does not link; of an
id's several vectors the smallest counts; null ids take no part; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import map_arrow, run_starts, stored, whole_runs
from placeseek.llm.components import components
from placeseek.llm.vectors import by_id

#: Vectors the rotations are learned from, at most (give or take the spread of a hash).
SAMPLE_ROWS = 20_000
TURNS = 30
TARGET_RECALL = 0.98
#: Substrings are keys of 16 bits at most.
MOST_BITS = 16
#: A row of a table costs as much as this many comparisons of two vectors.
ROW_COST = 256
#: Pairs of each kind that the plan is measured on, and rotations its first estimate takes.
PLAN_PAIRS, PLAN_ROTATIONS = 4000, 4
TILE_ROWS = 1024
_ROWS_AT_ONCE = 4096


def plan_tables(n: int, threshold: float, measured: dict[int, tuple[float, float]] | None = None) -> tuple[int, int]:
    """Bits of a substring, and number of tables, of the least work for ``n`` vectors.

    ``measured`` holds by bits the share of pairs at the threshold that agree in a
    substring, and the share of any two vectors that do; without it, those of vectors
    spread evenly about the centre."""
    if measured is None:
        agree = 1 - math.acos(threshold) / math.pi
        measured = {b: (agree**b, 0.5**b) for b in range(1, MOST_BITS + 1)}
    plans = []
    for bits, (hit, crowd) in measured.items():
        if hit > 0:
            tables = max(math.ceil(math.log(1 - TARGET_RECALL) / math.log1p(-min(hit, 1 - 1e-9))), 1)
            plans.append((tables * (ROW_COST + n * crowd / 2), bits, tables))
    return min(plans)[1:]


def threshold_pairs(sample: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sample vectors, and for each two vectors at the threshold cosine: turned
    towards another sample vector, and in a random direction."""
    rng = np.random.default_rng(0)
    x = sample[rng.integers(0, len(sample), PLAN_PAIRS)]
    random = rng.normal(size=x.shape)
    out = []
    for towards in (sample[rng.integers(0, len(sample), PLAN_PAIRS)], random):
        side = towards - (towards * x).sum(1, keepdims=True) * x
        length = np.linalg.norm(side, axis=1, keepdims=True)
        other = random - (random * x).sum(1, keepdims=True) * x
        side = np.where(length > 1e-6, side, other)  # the same direction: turned at random
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        out.append(threshold * x + math.sqrt(1 - threshold * threshold) * side)
    return x, out


def measured_plan(sample: np.ndarray, n: int, threshold: float) -> tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]:
    """Bits, number of tables and the rotations, with which ``TARGET_RECALL`` of the
    sample's ``threshold_pairs`` of either kind share a substring."""
    dims = sample.shape[1]
    x, near = threshold_pairs(sample, threshold)
    rotations = [learn_rotation(sample, seed) for seed in range(PLAN_ROTATIONS)]
    measured = {}
    for bits in range(1, min(MOST_BITS, dims) + 1):
        every = dims // bits * len(rotations)
        own = substrings(x, rotations, bits, every)
        hit = min(float((own == substrings(other, rotations, bits, every)).mean()) for other in near)
        crowds = [np.bincount(column, minlength=1 << bits) for column in own.T]
        measured[bits] = hit, float(np.mean([(c / len(x)) @ (c / len(x)) for c in crowds]))
    bits, tables = plan_tables(n, threshold, measured)
    while True:
        rotations += [learn_rotation(sample, seed) for seed in range(len(rotations), -(-tables // (dims // bits)))]
        own = substrings(x, rotations, bits, tables)
        if all((own == substrings(other, rotations, bits, tables)).any(axis=1).mean() >= TARGET_RECALL for other in near):
            return bits, tables, rotations[: -(-tables // (dims // bits))]
        tables += max(tables // 8, 1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by a power of two first, so squares stay in range)."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = np.ldexp(vectors, -np.frexp(top)[1])
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn_rotation(sample: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(centre, axes): the code of x is the signs of (x - centre) @ axes."""
    centre = sample.mean(axis=0)
    x = sample - centre
    _, axes = np.linalg.eigh(x.T @ x)
    x = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(x.shape[1], x.shape[1])))
    for _ in range(TURNS):
        signs = np.where(x @ turn >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(x.T @ signs)
        turn = u @ vt
    return centre, axes @ turn


def substrings(x: np.ndarray, rotations: list[tuple[np.ndarray, np.ndarray]], bits: int, tables: int) -> np.ndarray:
    """The keys of each row (rows x tables, unsigned 16-bit)."""
    out = []
    for centre, axes in rotations:
        signs = (x - centre) @ axes >= 0
        for start in range(0, signs.shape[1] - bits + 1, bits):
            out.append(signs[:, start : start + bits] @ (1 << np.arange(bits)))
            if len(out) == tables:
                return np.stack(out, 1).astype("<u2")
    raise ValueError("too few rotations")


def compare_tile(ids, weights, chunks, vectors, codes, table: int, threshold: float):
    """Links of one tile: (weighted number per row, links to the smallest id of its part).

    With two chunks only pairs across them count; pairs that an earlier table
    brings together are left to it."""
    order = np.argsort(ids, kind="stable")
    ids, weights, chunks, codes = ids[order], weights[order], chunks[order], codes[order]
    x = vectors[order]
    top = np.abs(x).max(axis=1, keepdims=True)
    x = np.ldexp(x, -np.frexp(top)[1])
    size = np.sqrt((x * x).sum(axis=1))
    linked = (x @ x.T) / (size[:, None] * size[None, :]) >= threshold
    np.fill_diagonal(linked, False)
    if chunks[0] != chunks[-1] or (chunks != chunks[0]).any():
        linked &= chunks[:, None] != chunks[None, :]
    if linked.any():
        for t in range(table):
            linked &= codes[:, t, None] != codes[None, :, t]
    counts = linked @ weights
    label = np.arange(len(ids))
    while True:
        least = np.where(linked, label[None, :], len(ids)).min(axis=1)
        lower = np.minimum(label, least)
        if (lower == label).all():
            break
        label = lower
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids, counts, ids[moved], ids[label[moved]]


def similarity_links(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector id: ``vec_id``, ``n_links`` (other vectors with cosine
    at least ``threshold`` found), ``component_id`` and ``kept``."""
    everyone = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    usable = by_id(vectors, id_col, vector_col).where(F.exists("_vector", lambda x: x != 0))
    usable = stored(usable, "itq-vectors")
    classes = usable.groupBy("_vector").agg(F.min("_id").alias("_rep"), F.count("_id").alias("_weight"))
    classes = stored(classes.select("_rep", "_weight", "_vector"), "itq-classes")
    sizes = classes.groupBy(F.size("_vector").alias("_dims")).count().orderBy("_dims").collect()
    found = [_links_of_size(classes.where(F.size("_vector") == r["_dims"]), r["_dims"], r["count"], threshold) for r in sizes]
    kinds = "_id long, _n long, _to long"
    all_found = vectors.sparkSession.createDataFrame([], kinds)
    for f in found:
        all_found = all_found.union(f)
    all_found = stored(all_found, "itq-found")
    counts = all_found.where(F.col("_to").isNull()).groupBy("_id").agg(F.sum("_n").alias("_n"))
    groups = components(all_found.where(F.col("_to").isNotNull()), "_id", "_to")

    members = usable.join(classes, "_vector").select(F.col("_id").alias("vec_id"), "_rep", "_weight")
    members = members.join(counts, F.col("_rep") == F.col("_id"), "left").drop("_id")
    members = members.join(groups, F.col("_rep") == F.col("id"), "left")
    members = members.select(
        "vec_id",
        (F.coalesce("_n", F.lit(0)) + F.col("_weight") - 1).alias("n_links"),
        F.coalesce("component_id", "_rep").alias("component_id"),
    )
    whole = everyone.join(members, "vec_id", "left")
    whole = whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return whole.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _links_of_size(classes: DataFrame, dims: int, n: int, threshold: float) -> DataFrame:
    """``_id``, ``_n``, null for counts and ``_id``, 0, ``_to`` for links, of vectors of one length."""
    spark = classes.sparkSession
    buckets = 1_000_003
    sample = classes.where(F.pmod(F.xxhash64("_rep"), F.lit(buckets)) < math.ceil(buckets * min(1.0, SAMPLE_ROWS / n)))
    rows = sample.orderBy("_rep").select("_vector").toArrow()["_vector"].combine_chunks()
    x = unit(rows.flatten().to_numpy().reshape(-1, dims)) if len(rows) else np.eye(dims)
    bits, tables, rotations = measured_plan(x, n, threshold)
    shared = spark.sparkContext.broadcast(rotations)  # a few dims x dims matrices

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                v = np.array(part.column(2).to_pylist(), np.float64).reshape(-1, dims)
                keys = substrings(unit(v), shared.value, bits, tables)
                narrow = v.astype(np.float32)
                exact = bool((narrow == v).all())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([r.tobytes() for r in (narrow if exact else v)], pa.binary()),
                        pa.array([r.tobytes() for r in keys], pa.binary()),
                        pa.array(keys.astype(np.int32).tolist(), pa.list_(pa.int32())),
                    ],
                    names=["_rep", "_weight", "_v", "_code", "_keys"],
                )

    coded = map_arrow(
        classes.select("_rep", "_weight", "_vector"), code, "_rep long, _weight long, _v binary, _code binary, _keys array<int>"
    )
    coded = stored(coded, "itq-codes")
    keyed = coded.select("_rep", "_weight", "_v", "_code", F.posexplode("_keys").alias("_table", "_key"))
    crowds = coded.select(F.posexplode("_keys").alias("_table", "_key")).groupBy("_table", "_key").agg(F.count("_key").alias("_rows"))
    alone = stored(crowds.where("_rows > 1"), "itq-buckets")
    keyed = keyed.join(alone, ["_table", "_key"])  # buckets of one have no pair
    chunks = F.ceil(F.col("_rows") / TILE_ROWS).cast("int")
    keyed = keyed.withColumn("_chunk", F.pmod(F.xxhash64("_rep"), chunks).cast("int"))
    keyed = keyed.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    tiles = ["_table", "_key", "_i", "_j"]
    keyed = keyed.select(
        "_table", "_key", F.least("_chunk", "_other").alias("_i"), F.greatest("_chunk", "_other").alias("_j"), "_chunk", "_rep", "_weight", "_v", "_code"
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartition(partitions, *tiles).sortWithinPartitions(*tiles)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_runs(batches, 4):
            yield _compare_runs(batch, dims, tables, threshold)

    return map_arrow(ordered, compare, "_id long, _n long, _to long")


def _compare_runs(batch: pa.RecordBatch, dims: int, tables: int, threshold: float) -> pa.RecordBatch:
    starts = run_starts(batch, 4)
    ends = np.append(starts[1:], batch.num_rows)
    table, i, j, chunk, ids, weights = (batch.column(c).to_numpy() for c in (0, 2, 3, 4, 5, 6))
    raw, codes = batch.column(7).to_pylist(), np.frombuffer(b"".join(batch.column(8).to_pylist()), "<u2").reshape(-1, tables)
    wide = [np.frombuffer(r, np.float32 if len(r) == 4 * dims else np.float64) for r in raw]
    vectors = np.array(wide, np.float64).reshape(-1, dims)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a < 2 or (i[a] != j[a] and (chunk[a:b] == chunk[a]).all()):
            continue
        own, n, left, right = compare_tile(ids[a:b], weights[a:b], chunk[a:b], vectors[a:b], codes[a:b], int(table[a]), threshold)
        some = n > 0
        if some.any():
            out.append((own[some], n[some], None))
            out.append((left, np.zeros(len(left), np.int64), right))
    counts = [pa.nulls(len(x[0]), pa.int64()) if x[2] is None else pa.array(x[2], pa.int64()) for x in out]
    join = lambda k: np.concatenate([x[k] for x in out]) if out else np.empty(0, np.int64)
    to = pa.concat_arrays(counts) if counts else pa.array([], pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(join(0), pa.int64()), pa.array(join(1), pa.int64()), to], names=["_id", "_n", "_to"])
