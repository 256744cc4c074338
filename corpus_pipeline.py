"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns a DataFrame; ``run`` writes each stage's result as Parquet in the
shared scratch folder and hands the reread table to the next.  All stages but the
last return the columns of ``documents``.

Null document ids cannot be grouped or compared by id: such rows pass the filters
like any other row and are left as they are by the two deduplication stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeseek.llm import minhash, packing, quality, substrings, toxicity
from placeseek.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _spare_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under the threshold; the model is fitted on
    the labelled rows of ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = _spare_name(docs, "toxicity")
    scored = toxicity.score(docs, model, out_col=out)
    return scored.where(F.col(f"`{out}`.score") < toxicity.THRESHOLD).select(*_columns(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = _spare_name(docs, "quality_score")
    scored = quality.score(docs, model, out_col=out)
    return scored.where(F.col(f"`{out}`") >= quality.THRESHOLD).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    groups = minhash.near_duplicates(docs)
    gone = stored(groups.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")), "near-duplicates")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document has; texts
    without such a passage stay as they are, and ``n_chars`` follows the text."""
    out = _spare_name(docs, "deduped")
    result = substrings.remove_repeats(docs, out_col=out)
    changed = F.col(f"`{out}`.n_removed") > 0
    new = {"text": F.col(f"`{out}`.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new["text"]).cast(docs.schema["n_chars"].dataType)
    return result.select(
        *[F.when(changed, new[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns]
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens that hold all texts."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Trained models and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
