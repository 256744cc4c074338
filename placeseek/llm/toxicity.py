"""Operator 7: toxicity by multiple-instance learning.

Only documents are labelled, yet it is a sentence that offends.  A sentence
has probability ``p = sigmoid(bias + sum of its words' weights)`` and a document
``1 - prod(1 - p)`` (noisy-or): toxic if at least one sentence is.  The weights
are learned from document labels alone by gradient descent on the likelihood
of that product, so each toxic document puts its weight on the sentences that
explain it, and the same weights then locate those sentences.

A word's features are the word in lower case and its first 3 to 6 letters, so
inflected forms not met in training count.  Features are hashed.  From the
training rows (a bounded sample, see ``labels``) Spark counts each feature's
documents by label; the features most tied to a label are kept, at most
``MAX_FEATURES``, and the model over them is fitted on the driver.

Defined results: null and empty texts have no sentence and the score 0; text
without a single known word gets the score that its number of sentences
implies; repeated rows get equal scores; without labels of both kinds every
score is the share of label 1 (0 if there are no labels); an empty table gives
no rows; other columns are kept by ``score`` as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeseek.llm.common import map_arrow
from placeseek.llm.labels import MAX_TRAINING_ROWS, training_rows
from placeseek.session import ship_package

MAX_FEATURES = 3_000
MIN_DOCUMENTS = 4
BUCKETS = 1 << 22
PREFIXES = (3, 4, 5, 6)
STEPS, RATE, DECAY = 400, 0.1, 2e-4
THRESHOLD = 0.5
_MEMO_WORDS = 400_000
_sentences = re.compile(r"[^.!?\n]+").finditer
_words = re.compile(r"\w+").findall


def word_features(word: str) -> list[int]:
    """Hashes of a lower-case word and of its first letters."""
    found = [crc32(b"=" + word.encode()) % BUCKETS]
    found += [crc32(word[:n].encode()) % BUCKETS for n in PREFIXES if n <= len(word)]
    return found


@dataclass
class ToxicModel:
    """``constant`` is set where there is nothing to learn from."""

    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    constant: float | None = None
    memo: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def weight(self, word: str) -> float:
        get = self.weights.get
        return sum([get(f, 0.0) for f in word_features(word)])

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) of the
        sentences that are more likely toxic than not."""
        if self.constant is not None:
            return self.constant, []
        text = text or ""
        memo = self.memo
        words = set(_words(text.lower()))
        new = words.difference(memo)
        if new:
            if len(memo) > _MEMO_WORDS:
                memo.clear()
                new = words
            memo.update([(w, self.weight(w)) for w in new])
        base = -_softplus(self.bias)  # log(1 - p) of a sentence without known words
        spans = [m.span() for m in _sentences(text)]
        spans = [s for s in spans if not text[s[0] : s[1]].isspace()]
        if not any(map(memo.__getitem__, words)):
            return -math.expm1(len(spans) * base), []
        log_none, found = 0.0, []
        for start, end in spans:
            z = self.bias + math.fsum(memo.get(w) or 0.0 for w in set(_words(text[start:end].lower())))
            log_none -= _softplus(z)
            if z >= 0:
                found.append((start, end, 1 / (1 + math.exp(-z))))
        return -math.expm1(log_none), found


def _softplus(z: float) -> float:
    return max(z, 0.0) + math.log1p(math.exp(-abs(z)))


def _feature_counts(rows: DataFrame) -> DataFrame:
    """Documents and documents of label 1 per hashed feature, summed in each task first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS), np.int32)
        memo: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                features: set[int] = set()
                for w in set(_words(text.lower())):
                    if w not in memo:
                        if len(memo) > _MEMO_WORDS // 4:
                            memo.clear()
                        memo[w] = word_features(w)
                    features.update(memo[w])
                n[y, np.fromiter(features, np.int64, len(features))] += 1
        at = np.flatnonzero(n.any(axis=0))
        for a in range(0, len(at), 1 << 16):
            part = at[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n[0, part]), pa.array(n[1, part])], names=["feature", "n0", "n1"])

    counts = map_arrow(rows, step, "feature long, n0 int, n1 int")
    return counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _bags(rows: DataFrame, chosen: list[int]) -> DataFrame:
    """Per row its label, its number of sentences, and the chosen features of
    each sentence that has any (flat, with the sentences' lengths)."""
    place = {f: i for i, f in enumerate(chosen)}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, n, flat, lengths = batch.column(1).to_pylist(), [], [], []
            for text in batch.column(0).to_pylist():
                sentences = [s for m in _sentences(text.lower()) if not (s := m.group()).isspace()]
                bags = [[place[f] for w in set(_words(s)) for f in word_features(w) if f in place] for s in sentences]
                bags = [b for b in bags if b]
                n.append(len(sentences))
                flat.append([f for b in bags for f in b])
                lengths.append([len(b) for b in bags])
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip((y, n, flat, lengths), kinds)], names=["y", "n", "flat", "lengths"]
            )

    return map_arrow(rows, step, "y int, n int, flat array<int>, lengths array<int>")


def fit(
    docs: DataFrame, labels: DataFrame, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> ToxicModel:
    rows = training_rows(docs, labels, target, id_col, text_col, max_rows)
    total, ones = rows.agg(F.count("y"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < ones < total:
        return ToxicModel(constant=ones / total if total else 0.0)
    # difference of the two shares in standard errors: how sure the tie is
    share0, share1, share = F.col("n0") / (total - ones), F.col("n1") / ones, (F.col("n0") + F.col("n1")) / total
    z = F.abs(share1 - share0) / F.sqrt(share * (1 - share) * (1 / ones + 1 / (total - ones)) + 1e-9)
    chosen = (
        _feature_counts(rows)
        .where(F.col("n0") + F.col("n1") >= MIN_DOCUMENTS)
        .select("feature", z.alias("z"))
        .where(F.col("z") > 3)
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_FEATURES)
    )
    features = [r["feature"] for r in chosen.collect()]
    bags = _bags(rows, features).toArrow()
    weights, bias = _descend(
        bags["y"].to_numpy(),
        bags["n"].to_numpy(),
        bags["flat"].combine_chunks().flatten().to_numpy(),
        bags["lengths"].combine_chunks(),
        len(features),
    )
    return ToxicModel(bias, dict(zip(features, weights.tolist())))


def _descend(y, n, flat, lengths, width) -> tuple[np.ndarray, float]:
    """Adam on the mean noisy-or likelihood; sentences without chosen features
    differ in number only and are counted, not listed."""
    per_doc = np.array([len(x) for x in lengths.to_pylist()], np.int64)
    of_sentence = np.repeat(np.arange(len(y)), per_doc)  # document of each listed sentence
    sizes = lengths.flatten().to_numpy()
    of_feature = np.repeat(np.arange(len(sizes)), sizes)  # sentence of each feature
    rest = n - per_doc
    w = np.zeros(width + 1)
    w[-1] = -5.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        z = w[-1] + np.bincount(of_feature, w[flat], len(sizes))
        soft = lambda x: np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))
        log_none = -np.bincount(of_sentence, soft(z), len(y)) - rest * soft(w[-1])
        p_any = np.maximum(-np.expm1(log_none), 1e-9)
        pull = np.where(y == 1, -np.exp(log_none) / p_any, 1.0) / len(y)  # d loss / d sum of softplus
        g_z = pull[of_sentence] / (1 + np.exp(-z))
        g = np.append(np.bincount(flat, g_z[of_feature], width), g_z.sum() + (pull * rest).sum() / (1 + np.exp(-w[-1])))
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``out_col``: ``score`` and ``sentences``,
    the offending sentences as array<struct<start, end, score>> (code points)."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_FEATURES weights
    sentence = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("sentences", pa.list_(sentence))])

    @F.arrow_udf("score double, sentences array<struct<start:int,end:int,score:double>>")
    def scored(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            p, found = shared.value.score(t.as_py())
            out.append({"score": p, "sentences": [{"start": a, "end": b, "score": q} for a, b, q in found]})
        return pa.array(out, kind)

    return docs.withColumn(out_col, scored(F.col(text_col)))
