"""Operator 8: removal of repeated passages by prefix-partitioned suffix trees.

A suffix starts at a word of a document and is cut after ``length`` words (50),
for deeper nodes change nothing: a word sequence of that length that starts in
two documents is an internal node at that depth.  Edges of the trees are
labelled by fingerprints of the words on the way (64 bits at the prefix, 128 at
the full depth).

1. A scan fingerprints every text.  Documents of the same word sequence form a
   class; all but the first are removed whole.  Of each window's runs of half
   its length the one of smallest fingerprint is its anchor; equal windows have
   equal anchors.  Anchors that occur in one document only rule their windows
   out, which leaves a few percent of the suffixes.
2. The remaining suffixes are dealt by their prefix.  The prefix has
   ``length // 2`` words; where more suffixes share it than fit ``GROUP_SUFFIXES``,
   it is extended to all ``length`` words, where a group is one node, whose
   smallest document a partial aggregate finds.
3. Each task builds the subtrees of its prefixes from its sorted suffixes and
   passes on those below a deep node that a smaller document reaches too.
4. Each document's marked windows give the words to remove.

Defined results: a null text has no words; texts under ``length`` words stay; a
null id is smaller than none and keeps its text; rows that repeat an id count as
one document and each get its result; windows are judged on the input; an empty
table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import map_arrow, slices, stored
from placeseek.llm.fingerprints import prefix_sums, rolling, sliding_min, word_hashes, words_of
from placeseek.session import ship_package

#: Suffixes of one prefix that one task may get before the prefix is extended.
GROUP_SUFFIXES = 50_000
_ROWS_AT_ONCE = 256


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def window_anchors(sums: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every window of ``length`` words."""
    half = length // 2
    return sliding_min(rolling(sums, half), length - half + 1)


def _scan(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``_id``, ``_n`` words, a 128-bit digest of the words, and the distinct anchors."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, _ROWS_AT_ONCE):
                n, d1, d2, flat = [], [], [], []
                for text in part.column(1).to_pylist():
                    h = word_hashes(words_of(text), memo)
                    n.append(len(h))
                    first, second = prefix_sums(h), prefix_sums(h, 1)
                    d1.append(first[-1])
                    d2.append(second[-1])
                    flat.append(_signed(np.unique(window_anchors(first, length))))
                ends = np.cumsum([0, *map(len, flat)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(_signed(np.array(d1, np.uint64))),
                        pa.array(_signed(np.array(d2, np.uint64))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))),
                    ],
                    names=["_id", "_n", "_d1", "_d2", "_anchors"],
                )

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return map_arrow(rows, step, "_id long, _n long, _d1 long, _d2 long, _anchors array<long>")


def _suffixes(texts: DataFrame, length: int) -> DataFrame:
    """Each document's distinct windows whose anchor is among its ``_anchors``:
    prefix, the two fingerprints of the window, document."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, _ROWS_AT_ONCE):
                for doc, text, repeated in zip(*(part.column(i).to_pylist() for i in range(3))):
                    h = word_hashes(words_of(text), memo)
                    sums = prefix_sums(h)
                    wanted = np.array(repeated, np.int64).view(np.uint64)
                    at = np.flatnonzero(np.isin(window_anchors(sums, length), wanted))
                    whole = rolling(sums, length)[at]
                    _, one = np.unique(whole, return_index=True)
                    at, whole = at[one], whole[one]
                    other = rolling(prefix_sums(h, 1), length, 1)[at]
                    columns = [rolling(sums, length // 2)[at], whole, other]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(_signed(c)) for c in columns), pa.array(np.full(len(at), doc, np.int64))],
                        names=["_prefix", "_f1", "_f2", "_id"],
                    )

    return map_arrow(texts, step, "_prefix long, _f1 long, _f2 long, _id long")


def _deep_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks sorted suffixes as a depth-first walk of the subtrees would: each
    run of equal fingerprints is a node at full depth, and its first row has the
    smallest document.  Gives the suffixes below it that are of a larger one.

    Only the open node is kept from batch to batch, so memory does not grow
    with a node."""
    open_node: tuple[int, int, int] | None = None
    first_doc = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        prefix, f1, f2, doc = (batch.column(i).to_numpy() for i in range(4))
        starts = np.empty(len(doc), bool)
        starts[0] = open_node != (prefix[0], f1[0], f2[0])
        starts[1:] = (prefix[1:] != prefix[:-1]) | (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])
        head = np.maximum.accumulate(np.where(starts, np.arange(len(doc)), -1))
        smallest = np.where(head >= 0, doc[head], first_doc)
        open_node, first_doc = (prefix[-1], f1[-1], f2[-1]), smallest[-1]
        again = np.flatnonzero(doc > smallest)
        yield pa.RecordBatch.from_arrays([pa.array(doc[again]), pa.array(f1[again])], names=["_id", "_f1"])


def repeated_windows(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with something to remove: ``_id``, ``_whole`` (an earlier
    document has the same words) and ``_windows``, fingerprints of its windows
    that also start in a document of smaller id."""
    scan = stored(_scan(docs, id_col, text_col, length), "substring-scan").where(F.col("_n") >= length)
    classes = scan.groupBy("_d1", "_d2", "_n").agg(F.min("_id").alias("_rep"))
    marked = scan.select("_id", "_d1", "_d2", "_n").distinct().join(classes, ["_d1", "_d2", "_n"])
    # an id can stand for several rows: only where all are copies is it no representative
    copies = marked.groupBy("_id").agg(F.min((F.col("_rep") < F.col("_id")).cast("int")).alias("_copy")).where("_copy = 1")
    copies = stored(copies.select("_id"), "substring-copies")

    anchors = scan.join(copies, "_id", "left_anti").select("_id", F.explode("_anchors").alias("_anchor"))
    shared = anchors.groupBy("_anchor").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"))
    shared = shared.where(F.col("_low") < F.col("_high")).select("_anchor")
    needed = anchors.join(shared, "_anchor").groupBy("_id").agg(F.collect_set("_anchor").alias("_anchors"))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    suffixes = stored(_suffixes(texts.join(needed, "_id").select("_id", "_text", "_anchors"), length), "substring-suffixes")

    crowded = suffixes.groupBy("_prefix").agg(F.count("_id").alias("_count")).where(F.col("_count") > GROUP_SUFFIXES)
    crowded = stored(crowded.select("_prefix"), "substring-prefixes")
    grouped = suffixes.join(crowded, "_prefix", "left_anti")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = grouped.repartition(partitions, "_prefix").sortWithinPartitions("_prefix", "_f1", "_f2", "_id")
    below = map_arrow(ordered, _deep_nodes, "_id long, _f1 long")
    extended = suffixes.join(crowded, "_prefix")
    nodes = extended.groupBy("_f1", "_f2").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"))
    nodes = nodes.where(F.col("_low") < F.col("_high"))
    also = extended.join(nodes, ["_f1", "_f2"]).where(F.col("_id") > F.col("_low")).select("_id", "_f1")

    windows = below.union(also).groupBy("_id").agg(F.collect_set("_f1").alias("_windows"))
    none = F.array().cast("array<long>")
    return windows.select("_id", F.lit(False).alias("_whole"), "_windows").union(
        copies.select("_id", F.lit(True).alias("_whole"), none.alias("_windows"))
    )


def remove_repeats(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", out_col: str = "deduped"
) -> DataFrame:
    """``docs`` with a struct column: ``text`` (the words kept, joined by one
    blank), ``n_words``, ``n_removed`` and ``spans``, the runs of removed words as
    array<struct<start, end>> in words."""
    repeats = stored(repeated_windows(docs, length, id_col, text_col), "substring-repeats")
    ship_package(docs.sparkSession)
    memo: dict[bytes, int] = {}
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span))])

    @F.arrow_udf("text string, n_words long, n_removed long, spans array<struct<start:int,end:int>>")
    def kept(texts: pa.Array, whole: pa.Array, windows: pa.Array) -> pa.Array:
        out = []
        for text, all_of_it, marked in zip(texts, whole, windows):
            words = words_of(text.as_py())
            n, spans = len(words), []
            if all_of_it.as_py():
                spans = [(0, n)]
            elif marked.is_valid:
                fingerprints = rolling(prefix_sums(word_hashes(words, memo)), length)
                at = np.flatnonzero(np.isin(_signed(fingerprints), np.array(marked.as_py(), np.int64)))
                if len(at):
                    cuts = np.flatnonzero(np.diff(at) > length) + 1
                    spans = [(int(a[0]), int(a[-1]) + length) for a in np.split(at, cuts)]
            removed = 0
            for start, end in reversed(spans):
                del words[start:end]
                removed += end - start
            out.append(
                {"text": b" ".join(words).decode(), "n_words": n, "n_removed": removed, "spans": [{"start": a, "end": b} for a, b in spans]}
            )
        return pa.array(out, kind)

    key = F.col(f"_docs.{id_col}").cast("long") == F.col("_repeats._id")
    joined = docs.alias("_docs").join(repeats.alias("_repeats"), key, "left")
    result = kept(F.col(f"_docs.{text_col}"), F.coalesce("_repeats._whole", F.lit(False)), F.col("_repeats._windows"))
    return joined.select("_docs.*", result.alias(out_col))
