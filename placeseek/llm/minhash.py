"""Operator 1: near-duplicate documents by BagMinHash.

A document is the multiset of its runs of ``SHINGLE`` words (five); a text of fewer words
has one run, all of them.  The similarity of two documents is the weighted
Jaccard similarity of their multisets, and they are linked from 0.8 on.

Signatures: a shingle's weights are cut into dyadic blocks [0,1), [1,2), [2,4),
[4,8) and so on.  Every block of every shingle carries a Poisson process of rate
equal to its width, seeded by the shingle; a point has a time, a place in the block
and a component.  A document that counts a shingle c times sees the points placed
below c.  A component's value is the earliest point it sees, so two documents agree
in a component with probability equal to their weighted Jaccard similarity.  Points
come in order of time, and a process is left once its time is past the latest value
of all components, so few points are ever drawn.

1. Documents of equal multisets form a class; the smallest id stands for it.
2. Components are banded.  Each member of a bucket is compared with the bucket's
   smallest id, and every such pair is verified on the whole texts.
3. In buckets that still hold several components, the rows outside the largest one ask all others: asking rows
   and all rows of a bucket are dealt into chunks and meet as tiles of bounded size, with their shingles (24 bits
   each).  A tile works out the similarity of every pair of different components that no earlier band brings
   together, and passes on one link per component that it joins: as many rows at most as it holds.  Cut shingles
   can only make a similarity larger, so no link is lost; the links passed on are verified on the whole texts, and
   should one fail, the tiles are worked through again without it.
4. Linked classes form connected components.

Defined results: null and empty texts are copies of one another and of nothing else;
null ids are left out; rows that repeat an id are one document, linked to all that any
of them links to; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import map_arrow, run_starts, slices, stored, whole_runs
from placeseek.llm.components import components
from placeseek.llm.fingerprints import mixed, prefix_sums, rolling, word_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5 components miss one pair in 20,000 at similarity 0.8.
BANDS, ROWS = 25, 5
#: Rows and shingles of a tile's side, about.
TILE_ROWS, TILE_SHINGLES = 4096, 1 << 22
PAIRS_PER_CHUNK = 512
_ROWS_AT_ONCE = 256
# Odd constants that part the random streams.
_STEP, _OTHER, _BLOCK = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(text: str | None, memo: dict[bytes, int]) -> np.ndarray:
    """64-bit fingerprints of the runs of five words, sorted."""
    h = word_hashes(words_of(text), memo)
    sums = prefix_sums(h)
    return np.sort(rolling(sums, min(SHINGLE, len(h)))) if len(h) else h


def weighted(sorted_shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.ones(len(sorted_shingles), bool)
    first[1:] = sorted_shingles[1:] != sorted_shingles[:-1]
    at = np.flatnonzero(first)
    return sorted_shingles[at], np.diff(np.append(at, len(sorted_shingles)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (distinct shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 1.0


def signature(elements: np.ndarray, counts: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """The earliest point's time per component (as the bits of a double)."""
    best = np.full(size, np.inf)
    if not len(elements):
        return best.view(np.uint64)
    blocks = np.frexp(counts - 0.5)[1].clip(0) + 1  # dyadic blocks that start below the count
    of = np.repeat(np.arange(len(elements)), blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    width = np.where(block == 0, 1.0, np.exp2(block - 1))
    start = np.where(block == 0, 0.0, width)
    count = counts[of].astype(np.float64)
    state = mixed(elements[of] + block.astype(np.uint64) * _BLOCK)
    time = np.zeros(len(of))
    while len(state):
        # few processes: several points of each at a time
        points = 1 if len(state) > size else -(-4 * size // len(state))
        steps = np.arange(1, points + 1, dtype=np.uint64) * _STEP
        draw = mixed(state[:, None] + steps[None, :])
        gap = -np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / width[:, None]
        # left to right, so a point's time does not depend on how many are drawn at once
        times = np.cumsum(np.concatenate((time[:, None], gap), axis=1), axis=1)[:, 1:]
        place = mixed(draw ^ _OTHER)
        component = ((place >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        level = start[:, None] + (place & np.uint64(0xFFFFFFFF)) * 2.0**-32 * width[:, None]
        seen = np.floor(level) < count[:, None]
        np.minimum.at(best, component[seen], times[seen])
        time, state = times[:, -1], state + steps[-1]
        go = time < best.max()
        if not go.all():
            state, time, width, start, count = (x[go] for x in (state, time, width, start, count))
    return best.view(np.uint64)


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_n`` shingles, a 128-bit digest of the multiset, and band keys."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        last: tuple[np.ndarray, list] = np.empty(0, np.uint64), []
        for batch in batches:
            for part in slices(batch, _ROWS_AT_ONCE):
                rows = []
                for text in part.column(1).to_pylist():
                    s = shingles(text, memo)
                    if not (last[1] and np.array_equal(s, last[0])):
                        values = signature(*weighted(s))
                        keys = mixed(values.reshape(BANDS, ROWS) * (2 * np.arange(ROWS, dtype=np.uint64) + _STEP))
                        keys = mixed(keys.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _BLOCK)
                        last = s, [len(s), *_digest(s), keys.view(np.int64).tolist()]
                    rows.append(last[1])
                columns = list(zip(*rows)) if rows else [[]] * 4
                kinds = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["_id", "_n", "_d1", "_d2", "_keys"]
                )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return map_arrow(rows, step, "_id long, _n long, _d1 long, _d2 long, _keys array<long>")


def _digest(sorted_shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of the multiset."""
    one, two = (mixed(sorted_shingles ^ c).sum(dtype=np.uint64) for c in (_STEP, _OTHER))
    return int(np.int64(one)), int(np.int64(two))


def _cut(sorted_shingles: np.ndarray) -> bytes:
    """24 bits of each shingle and of how often it has been there before, so that what two multisets share is
    what the two sets share."""
    first = np.ones(len(sorted_shingles), bool)
    first[1:] = sorted_shingles[1:] != sorted_shingles[:-1]
    at = np.arange(len(sorted_shingles))
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    cut = mixed(sorted_shingles + nth.astype(np.uint64) * _BLOCK) & np.uint64(0xFFFFFF)
    return np.ascontiguousarray(cut.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _uncut(raw: bytes) -> np.ndarray:
    three = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
    return three[:, 0] | three[:, 1] << 8 | three[:, 2] << 16


def _bags(texts: DataFrame) -> DataFrame:
    """``_id``, ``_d1`` (of the digest) and the cut shingles of each text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, _ROWS_AT_ONCE):
                found = [shingles(t, memo) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_digest(s)[0] for s in found], pa.int64()), pa.array([_cut(s) for s in found], pa.binary())],
                    names=["_id", "_d1", "_bag"],
                )

    return map_arrow(texts.select("_id", "_text"), step, "_id long, _d1 long, _bag binary")


def _verified(pairs: DataFrame, texts: DataFrame, at_least: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity.

    b's text meets those of its partners; a b with many partners is dealt into chunks, each of
    which gets its own copy of b's text."""
    per = pairs.groupBy("b").agg(F.ceil(F.count("a") / PAIRS_PER_CHUNK).cast("int").alias("_chunks"))
    dealt = pairs.join(per, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("_chunks")).cast("int").alias("_chunk"))
    dealt = stored(dealt, "minhash-pairs")
    heads = dealt.select("b", "_chunk").distinct().join(texts.hint("merge"), F.col("b") == F.col("_id"))
    partners = dealt.join(texts.hint("merge"), F.col("a") == F.col("_id"))
    rows = heads.select("b", "_chunk", F.lit(None).cast("long").alias("a"), "_text").union(partners.select("b", "_chunk", "a", "_text"))
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "b", "_chunk").sortWithinPartitions("b", "_chunk", F.col("a").asc_nulls_first())

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        of, heads = None, []  # texts of the open b: one, unless rows repeat its id
        for batch in batches:
            left, right = [], []
            b, chunk, a, text = (batch.column(i) for i in range(4))
            for key, x, t in zip(zip(b.to_pylist(), chunk.to_pylist()), a.to_pylist(), text.to_pylist()):
                bag = weighted(shingles(t, memo))
                if x is None:
                    heads = [*heads, bag] if key == of else [bag]
                    of = key
                elif any(similarity(bag, h) >= at_least for h in heads):
                    left.append(x)
                    right.append(key[0])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return map_arrow(rows, step, "a long, b long")


class _Tile:
    """Rows of one bucket: some ask, some answer, each has a component and a bag of cut shingles."""

    def __init__(self, asks, answers, outside, ids, parts, keys, bags: list[np.ndarray], failed: set[tuple[int, int]]):
        self.asks, self.answers, self.outside, self.ids, self.keys, self.failed = asks, answers, outside, ids, keys, failed
        self.parts = parts.copy()
        self.sizes = np.array([len(b) for b in bags])
        known, numbers = np.unique(np.concatenate(bags), return_inverse=True)
        self.known = len(known)
        self.bags = np.split(numbers.ravel().astype(np.int32), np.cumsum(self.sizes)[:-1])

    def links(self, band: int, at_least: float) -> list[tuple[int, int]]:
        """One pair (greater id, smaller id) for each two components that are joined."""
        out, inside = [], np.zeros(self.known, np.uint8)
        others = np.flatnonzero(self.answers)
        sizes = self.sizes[others]
        for x in np.flatnonzero(self.asks).tolist():
            size = self.sizes[x]
            open_ = (self.parts[others] != self.parts[x]) & (sizes >= at_least * size) & (size >= at_least * sizes)
            open_ &= ~self.outside[others] | (self.ids[others] < self.ids[x])  # two that ask: once
            near = others[open_]
            if band and len(near):  # left to the first band that brings them together
                near = near[~(self.keys[near, :band] == self.keys[x, :band]).any(axis=1)]
            if not len(near):
                continue
            inside[self.bags[x]] = 1
            lengths = self.sizes[near]
            found = inside[np.concatenate([self.bags[y] for y in near.tolist()])]
            inside[self.bags[x]] = 0
            shared = np.add.reduceat(found, np.cumsum(lengths) - lengths, dtype=np.int64)
            shared = np.minimum(shared, np.minimum(lengths, size))
            alike = shared / (size + lengths - shared)
            for k in np.argsort(-alike, kind="stable").tolist():
                if alike[k] < at_least:
                    break
                y = near[k]
                pair = (int(max(self.ids[x], self.ids[y])), int(min(self.ids[x], self.ids[y])))
                if self.parts[x] != self.parts[y] and pair not in self.failed:
                    out.append(pair)
                    self.parts[self.parts == self.parts[y]] = self.parts[x]
        return out


def _tile_links(rows: DataFrame, at_least: float) -> DataFrame:
    """The pairs (a, b) that the tiles pass on."""
    tiles = ["_key", "_i", "_j"]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["_asks", "_answers", "_outside", "_id", "_component", "_band", "_keys", "_bag", "_not"]
    ordered = rows.select(*tiles, *columns).repartition(partitions, *tiles).sortWithinPartitions(*tiles)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_runs(batches, 3):
            starts = run_starts(batch, 3)
            found: list[tuple[int, int]] = []
            for a, b in zip(starts.tolist(), np.append(starts[1:], batch.num_rows).tolist()):
                one = batch.slice(a, b - a)
                asks, answers, outside, ids, parts, band = (one.column(i).to_numpy(zero_copy_only=False) for i in range(3, 9))
                if not asks.any():
                    continue
                keys = one.column(9).flatten().to_numpy().reshape(len(ids), -1)
                bags = [_uncut(raw) for raw in one.column(10).to_pylist()]
                failed = {(i, x) for i, xs in zip(ids.tolist(), one.column(11).to_pylist()) for x in xs or ()}
                found += _Tile(asks, answers, outside, ids, parts, keys, bags, failed).links(int(band[0]), at_least)
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return map_arrow(ordered, step, "a long, b long")


def _tiled(named: DataFrame, keys: DataFrame, texts: DataFrame, failed: DataFrame) -> DataFrame:
    """The rows of buckets with several components, once for each tile that they take part in."""
    parts = named.groupBy("_key", "_component").agg(F.count("_id").alias("_size"), F.sum("_n").alias("_weight"))
    parts = parts.groupBy("_key").agg(
        F.max(F.struct("_size", "_component", "_weight")).alias("_main"), F.sum("_size").alias("_all"),
        F.sum("_weight").alias("_whole"), F.count("_size").alias("_parts"),
    )
    chunks = lambda rows, weight: F.greatest(F.ceil(rows / TILE_ROWS), F.ceil(weight / TILE_SHINGLES), F.lit(1)).cast("int")
    parted = parts.where("_parts > 1").select(
        "_key", F.col("_main._component").alias("_most"), chunks(F.col("_all"), F.col("_whole")).alias("_across"),
        chunks(F.col("_all") - F.col("_main._size"), F.col("_whole") - F.col("_main._weight")).alias("_down"),
    )
    rows = stored(named.join(parted, "_key"), "minhash-parted")
    needed = rows.select("_id").distinct()
    bags = _bags(texts.join(needed.hint("merge"), "_id", "left_semi")).dropDuplicates(["_id", "_d1"])
    refused = failed.groupBy(F.col("a").alias("_id")).agg(F.collect_list("b").alias("_not"))  # a leader for each band, at most
    held = keys.join(bags, ["_id", "_d1"]).join(refused, "_id", "left")

    outside, alone = F.col("_component") != F.col("_most"), (F.col("_across") == 1) & (F.col("_down") == 1)
    own = F.xxhash64("_id")
    place = lambda i, j, asks, answers: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), asks.alias("asks"), answers.alias("answers"))
    answering = F.transform(
        F.sequence(F.lit(0), F.col("_down") - 1), lambda j: place(F.pmod(own, F.col("_across")), j, alone & outside, F.lit(True))
    )
    asking = F.transform(
        F.sequence(F.lit(0), F.col("_across") - 1), lambda i: place(i, F.pmod(own, F.col("_down")), F.lit(True), F.lit(False))
    )
    rows = rows.withColumn("_at", F.explode(F.when(outside & ~alone, F.concat(answering, asking)).otherwise(answering)))
    rows = rows.select(
        "_id", "_d1", "_key", "_band", "_component", outside.alias("_outside"),
        F.col("_at.i").alias("_i"), F.col("_at.j").alias("_j"), F.col("_at.asks").alias("_asks"), F.col("_at.answers").alias("_answers"),
    )
    return rows.join(held.hint("merge"), ["_id", "_d1"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = SIMILARITY) -> DataFrame:
    """One row per document id: ``doc_id``, ``class_id`` (smallest id of the documents with
    the same shingles), ``component_id`` (smallest id reachable over links) and ``kept``."""
    scan = stored(_scan(docs, id_col, text_col), "minhash-scan")
    digest = ["_d1", "_d2", "_n"]
    classes = scan.groupBy(*digest).agg(F.min("_id").alias("class_id"))
    members = scan.select("_id", *digest).distinct().join(classes, digest).select("_id", "class_id")
    members = stored(members, "minhash-members")
    reps = members.where("_id = class_id").select("_id")
    standing = scan.where("_n > 0").join(reps, "_id", "left_semi").dropDuplicates(["_id", "_d1"])

    banded = standing.select("_id", "_d1", "_n", F.posexplode("_keys").alias("_band", "_key"))
    buckets = banded.groupBy("_key").agg(F.min("_id").alias("_leader"), F.max("_id").alias("_last"), F.count("_id").alias("_rows"))
    buckets = buckets.where(F.col("_leader") < F.col("_last")).drop("_last")
    bucketed = stored(banded.join(buckets, "_key"), "minhash-buckets")
    wanted = bucketed.select("_id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    texts = stored(texts.join(wanted.hint("merge"), "_id", "left_semi"), "minhash-texts")

    tried = bucketed.where("_id > _leader").select(F.col("_id").alias("a"), F.col("_leader").alias("b")).distinct()
    tried = stored(tried, "minhash-tried")
    # an id that stands in several classes joins them
    twofold = members.groupBy("_id").agg(F.min("class_id").alias("b"), F.max("class_id").alias("a")).where("b < a").select("a", "b")
    links = stored(_verified(tried, texts, at_least).union(twofold), "minhash-links")
    groups = components(links)
    keys = standing.select("_id", "_d1", "_keys")
    larger = bucketed.where("_rows > 2").select("_id", "_d1", "_n", "_key", "_band")
    while True:
        named = larger.join(groups.withColumnRenamed("id", "_id"), "_id", "left")
        named = named.withColumn("_component", F.coalesce("component_id", "_id")).drop("component_id")
        failed = tried.join(links, ["a", "b"], "left_anti")
        new = _tile_links(_tiled(named, keys, texts, failed), at_least)
        new = stored(new.distinct(), "minhash-new")
        if new.isEmpty():
            break
        fit = stored(_verified(new, texts, at_least), "minhash-fit")
        links = stored(links.union(fit), "minhash-links")
        groups = components(links)
        if new.join(fit, ["a", "b"], "left_anti").isEmpty():
            break  # the tiles have seen every pair, and what they joined is joined
        tried = tried.union(new)
    whole = members.join(groups, F.col("class_id") == F.col("id"), "left")
    return (
        whole.groupBy(F.col("_id").alias("doc_id"))
        .agg(F.min("class_id").alias("class_id"), F.min(F.coalesce("component_id", "class_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
