"""Operator 2: a quality classifier, a factorisation machine.

Inputs of a score: the text's distinct words (lower case, hashed), statistics
of its structure, and its length.  With inputs x the logit is

    w0 + sum w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so that all pairs of inputs interact through vectors of ``RANK`` numbers in
time linear in the inputs.  The machine is fitted on the driver from a bounded
sample of labelled rows (see ``labels``), whose inputs Spark works out.

Defined results: null and empty texts have no words and the statistics of an
empty text, and get a score like any other; repeated rows get equal scores;
without labels of both kinds every score is the share of label 1 (0.5 if there
are no labels); an empty table gives no rows; other columns are kept by
``score`` as they are.
"""

from __future__ import annotations

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

WORD_BUCKETS = 1 << 13
RANK = 6
STEPS, RATE, DECAY = 150, 0.05, 1e-4
#: Rows whose inputs the fit spreads out at a time.
ROWS_PER_BLOCK = 1000
THRESHOLD = 0.3
_MEMO_WORDS = 400_000
_words = re.compile(r"\w+").findall
# The characters whose share of the text is a statistic of its own.
COUNTED = "!?.,;:|*#$%&@<>{}[]()/\\=_-+0123456789\n\t"


def statistics(text: str, n_words: int, n_distinct: int, word_chars: int) -> list[float]:
    """What the shape of a text says about it; shares and logarithms of sizes."""
    n = len(text)
    lines = text.split("\n")
    tokens = text.split()
    upper = sum(map(str.isupper, tokens))
    shares = [text.count(c) / (n + 1) for c in COUNTED]
    odd = sum(shares[COUNTED.index("|") : COUNTED.index("0")])
    digits = sum(shares[COUNTED.index("0") : COUNTED.index("\n")])
    return [
        np.log1p(n),
        np.log1p(n_words),
        np.log1p(len(lines)),
        n_distinct / (n_words + 1),
        word_chars / (n_words + 1),
        len(tokens) / (n_words + 1),
        len(set(tokens)) / (len(tokens) + 1),
        len(set(lines)) / len(lines),
        upper / (len(tokens) + 1),
        float(n == 0),
        odd,
        digits,
        *np.sqrt(shares).tolist(),
    ]


N_STATISTICS = 12 + len(COUNTED)


def inputs(text: str | None, memo: dict[str, int]) -> tuple[list[int], list[float]]:
    """Buckets of the distinct words, and the statistics."""
    text = text or ""
    words = _words(text.lower())
    distinct = set(words)
    new = distinct.difference(memo)
    if new:
        if len(memo) > _MEMO_WORDS:
            memo.clear()
            new = distinct
        memo.update([(w, crc32(w.encode()) % WORD_BUCKETS) for w in new])
    buckets = sorted(set(map(memo.__getitem__, distinct)))
    return buckets, statistics(text, len(words), len(distinct), sum(map(len, words)))


@dataclass
class QualityModel:
    """Weights of word buckets first, then of the standardised statistics."""

    w0: float = 0.0
    w: np.ndarray | None = None
    v: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    constant: float | None = None
    memo: dict[str, int] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant if texts else 0.0)
        found = [inputs(t, self.memo) for t in texts]
        counts = np.array([len(b) for b, _ in found])
        flat = np.array([b for x, _ in found for b in x], np.int64)
        stats = standardised(np.array([s for _, s in found]), self.mean, self.scale)
        logit = _logits(self.w0, self.w, self.v, flat, counts, stats)[0]
        return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def standardised(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / scale, -4, 4)


def _sums_by_row(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` values."""
    if not len(counts):
        return np.empty(0)
    out = np.add.reduceat(np.append(x, 0.0), np.cumsum(counts) - counts)
    out[counts == 0] = 0.0
    return out


def _logits(w0, w, v, flat, counts, stats):
    """Logits, and the sums (a row per factor) that the gradient needs again."""
    word = 1 / np.sqrt(np.maximum(counts, 1))
    linear = _sums_by_row(w[flat], counts) * word + stats @ w[WORD_BUCKETS:]
    factors, q = np.ascontiguousarray(v[:WORD_BUCKETS].T), v[WORD_BUCKETS:]
    sums = np.stack([_sums_by_row(f[flat], counts) * word for f in factors]) + (stats @ q).T
    lengths = (factors * factors).sum(0)
    squares = _sums_by_row(lengths[flat], counts) * word * word + (stats * stats) @ (q * q).sum(1)
    return w0 + linear + 0.5 * ((sums * sums).sum(0) - squares), sums, word


def _gradient(p, y, flat, counts, stats):
    """Gradient of the likelihood (a sum over these rows) at the weights ``p``."""
    w0, w, v = p
    logit, sums, word = _logits(w0, w, v, flat, counts, stats)
    g = 1 / (1 + np.exp(-logit)) - y
    spread = lambda x: np.repeat(x, counts)
    g_w = np.concatenate((np.bincount(flat, spread(g * word), WORD_BUCKETS), stats.T @ g))
    pull = np.bincount(flat, spread(g * word * word), WORD_BUCKETS)
    g_v = np.empty_like(v)
    for f in range(RANK):
        g_v[:WORD_BUCKETS, f] = np.bincount(flat, spread(g * word * sums[f]), WORD_BUCKETS) - pull * v[:WORD_BUCKETS, f]
    g_v[WORD_BUCKETS:] = stats.T @ (g * sums).T - ((stats * stats).T @ g)[:, None] * v[WORD_BUCKETS:]
    return np.concatenate(([g.sum()], g_w, g_v.ravel()))


def _descend(y, flat, counts, stats, seed: int = 7):
    """Adam on the mean likelihood of all rows; the gradient is summed over blocks of rows,
    so that only one block's inputs are spread out at a time."""
    size = WORD_BUCKETS + stats.shape[1]
    rng = np.random.default_rng(seed)
    p = np.concatenate(([0.0], np.zeros(size), rng.normal(0, 0.05, size * RANK)))
    m, s = np.zeros_like(p), np.zeros_like(p)
    edges = np.concatenate(([0], np.cumsum(counts)))
    blocks = [(a, min(a + ROWS_PER_BLOCK, len(y))) for a in range(0, len(y), ROWS_PER_BLOCK)]
    decay = np.full(len(p), DECAY)
    decay[0] = 0
    for t in range(1, STEPS + 1):
        weights = p[0], p[1 : size + 1], p[size + 1 :].reshape(size, RANK)
        grad = np.zeros_like(p)
        for a, b in blocks:
            grad += _gradient(weights, y[a:b], flat[edges[a] : edges[b]], counts[a:b], stats[a:b])
        grad = grad / len(y) + decay * p
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        p = p - RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return float(p[0]), p[1 : size + 1], p[size + 1 :].reshape(size, RANK)


def fit(
    docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> QualityModel:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        for batch in batches:
            found = [inputs(t, memo) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([b for b, _ in found], pa.list_(pa.int32())), pa.array([s for _, s in found], pa.list_(pa.float64()))],
                names=["y", "words", "stats"],
            )

    rows = map_arrow(training_rows(docs, labels, target, id_col, text_col, max_rows), step, "y int, words array<int>, stats array<double>")
    got = rows.toArrow()
    y = got["y"].to_numpy()
    if not 0 < y.sum() < len(y):
        return QualityModel(constant=float(y.mean()) if len(y) else 0.5)
    words = got["words"].combine_chunks()
    counts, flat = words.value_lengths().to_numpy(), words.flatten().to_numpy().astype(np.uint16)
    stats = got["stats"].combine_chunks().flatten().to_numpy().reshape(len(y), N_STATISTICS)
    del got, words
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    w0, w, v = _descend(y, flat, counts, standardised(stats, mean, scale))
    return QualityModel(w0, w, v, mean, scale)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 as ``out_col``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a fixed number of weights

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = []
        for a in range(0, len(texts), 256):
            out.append(shared.value.score(texts.slice(a, 256).to_pylist()))
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return docs.withColumn(out_col, scored(F.col(text_col)))
