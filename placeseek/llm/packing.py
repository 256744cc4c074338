"""Operator 10: packing by concatenating and cutting.

All token ids, document after document, form one long sequence that is cut
every ``length`` ids.  Two passes give each document its place:

1. every task tokenizes its documents (by byte-pair ranks, after a test that they say the same as the
   file's merge list) and notes for each the ids its task had
   before it; the ids are written once to the shared folder;
2. the tasks' totals are summed up (blocks of tasks first, so no window meets
   more than a thousandth of them), which gives each task's first global
   position; a document's ids are then cut at multiples of ``length``, with one
   boundary record per piece.

Only the last sequence can be short, so padding is under one sequence for the
whole corpus.  A sequence is padded to ``length`` unless it holds a power of
two of ids (``padded_length``).

Defined results: a null or empty text has only the closing id; null document
ids and repeated rows are packed like any other row; a very long text gives
many pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeseek.llm.bpe import ROWS_AT_ONCE, RankBpe, built, share
from placeseek.llm.common import map_arrow, slices, stored

#: Tasks whose totals are summed in one window.
TASKS_PER_BLOCK = 1024
_PIECES_AT_ONCE = 2048


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``task``, ``before`` (ids of the task's earlier documents), id, ``n`` and ``ids``."""
    spec = share(docs.sparkSession, tokenizer)
    id_type = docs.schema[id_col].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, at = built(spec, RankBpe), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        narrow = max(bpe.width, end_id + 1) <= 1 << 16
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                raw = [r + end for r in bpe.encode(part.column(1).to_pylist())]
                n = np.array([len(r) // 4 for r in raw], np.int64)
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                kept = [np.frombuffer(r, "<u4").astype("<u2").tobytes() for r in raw] if narrow else raw
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), task, np.int64)), pa.array(before), part.column(0), pa.array(n), pa.array(kept, pa.binary())],
                    names=["_task", "_before", id_col, "_n", "_ids"],
                )

    return map_arrow(
        docs.select(id_col, text_col), step, f"_task long, _before long, `{id_col}` {id_type}, _n long, _ids binary"
    )


def _first_positions(rows: DataFrame) -> DataFrame:
    """Per task: ``_first``, the ids of all earlier tasks, and ``_all``, those of all tasks."""
    tasks = rows.groupBy("_task").agg(F.sum("_n").alias("_sum"))
    tasks = tasks.withColumn("_block", F.floor(F.col("_task") / TASKS_PER_BLOCK))
    blocks = tasks.groupBy("_block").agg(F.sum("_sum").alias("_of"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_of").over(earlier), F.lit(0)).alias("_base"),
        F.sum("_of").over(everything).alias("_all"),
    )
    inside = Window.partitionBy("_block").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_task", "_block", F.coalesce(F.sum("_sum").over(inside), F.lit(0)).alias("_own"))
    # one row per thousand tasks
    return tasks.join(F.broadcast(blocks), "_block").select("_task", (F.col("_base") + F.col("_own")).alias("_first"), "_all")


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: the document id, ``start`` (ids of the document
    before it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence and ``padded_length`` of the sequence."""
    rows = stored(_tokenized(docs, tokenizer, end_id, id_col, text_col), "packing-ids")
    # one row per task of the first pass: as many as Spark's own scheduler holds
    placed = rows.join(F.broadcast(_first_positions(rows)), "_task").select(
        id_col, "_n", "_ids", (F.col("_first") + F.col("_before")).alias("_at"), "_all"
    )
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                yield from pieces(part)

    def pieces(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n, at, total = (part.column(c).to_numpy() for c in ("_n", "_at", "_all"))
        first, last = at // length, (at + n - 1) // length
        counts = last - first + 1
        doc = np.repeat(np.arange(len(n)), counts)
        sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.maximum(sequence * length, at[doc])
        stop = np.minimum((sequence + 1) * length, (at + n)[doc])
        fill = np.minimum(length, total[doc] - sequence * length)
        padded = np.where(fill & (fill - 1), length, fill)
        values = part.column("_ids")
        wide: dict[int, bytes] = {}
        out = []
        for i, a, b in zip(doc.tolist(), (begin - at[doc]).tolist(), (stop - at[doc]).tolist()):
            if i not in wide:
                raw = values[i].as_py()
                wide = {i: raw if len(raw) == 4 * n[i] else np.frombuffer(raw, "<u2").astype("<u4").tobytes()}
            out.append(wide[i][4 * a : 4 * b])
        whole = pa.RecordBatch.from_arrays(
            [
                part.column(id_col).take(pa.array(doc)),
                pa.array(begin - at[doc]),
                pa.array(stop - begin),
                pa.array(out, pa.binary()),
                pa.array(n[doc]),
                pa.array(sequence),
                pa.array(begin - sequence * length),
                pa.array(padded),
            ],
            names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"],
        )
        yield from slices(whole, _PIECES_AT_ONCE)

    return map_arrow(
        placed,
        cut,
        f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, padded_length long",
    )
