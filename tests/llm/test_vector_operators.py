"""Operators 4 and 6 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from placeseek.llm import itq, queries, topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"
NAN, INF = float("nan"), float("inf")


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in vectors], schema)


def brute_links(ids, x, threshold=0.9):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], len(ids)).min(axis=1))
        if (lower == label).all():
            return linked.sum(axis=1), ids[label]
        label = lower


def clustered(rng, n, dims=32, groups=12, hot=0):
    centres = rng.normal(size=(groups, dims))
    of = np.where(np.arange(n) < hot, 0, rng.integers(0, groups, n))
    x = centres[of] + rng.normal(size=(n, dims)) * rng.choice([0.05, 0.25, 1.0], n)[:, None]
    return x.astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("tile", [1024, 16])
def test_links_and_components(spark, monkeypatch, tile):
    monkeypatch.setattr(itq, "TILE_ROWS", tile)
    rng = np.random.default_rng(tile)
    x = clustered(rng, 500, hot=170)
    x[20:40] = x[19]  # copies
    ids = rng.permutation(5000)[:500]
    order = np.argsort(ids)
    n, component = brute_links(ids[order], x[order])
    got = {r["vec_id"]: r for r in itq.similarity_links(frame(spark, list(zip(ids.tolist(), x.tolist())))).collect()}
    assert set(got) == set(ids.tolist())
    found = np.array([got[i]["n_links"] for i in ids[order].tolist()])
    assert (found <= n).all() and found.sum() >= 0.95 * n.sum()
    same = [got[i]["component_id"] == c for i, c in zip(ids[order].tolist(), component.tolist())]
    assert np.mean(same) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_links_of_odd_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, one), (2, one), (3, [2 * v for v in one]), (4, None), (5, [0.0] * 4), (6, [1.0, NAN, 0.0, 0.0]), (7, [INF, 1.0, 1.0, 1.0]), (8, [1.0, 2.0]), (9, []), (1, one), (None, one)]
    rows.append((10, [1.0, None, 2.0, 3.0]))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in itq.similarity_links(frame(spark, rows)).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)) and len(got) == 10
    assert itq.similarity_links(frame(spark, [])).count() == 0


def test_recall_plan_holds_at_the_threshold():
    rng = np.random.default_rng(1)
    bits, tables = itq.plan_tables(50_000, 0.9)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = rng.normal(size=x.shape)
    other -= (other * x).sum(1)[:, None] * x
    other /= np.linalg.norm(other, axis=1)[:, None]
    near = 0.9 * x + np.sqrt(1 - 0.81) * other  # cosine exactly at the threshold
    rotations = [itq.learn_rotation(x, s) for s in range(-(-tables // (64 // bits)))]
    hit = (itq.substrings(x, rotations, bits, tables) == itq.substrings(near, rotations, bits, tables)).any(axis=1)
    assert hit.mean() > 0.95


@pytest.mark.parametrize("mean_cosine", [0.0, 0.4, 0.7])
def test_links_near_the_threshold_of_vectors_with_a_common_direction(spark, mean_cosine):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1200, 64))
    x = np.sqrt(1 - mean_cosine) * x / np.linalg.norm(x, axis=1)[:, None]
    x[:, 0] += np.sqrt(mean_cosine)
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = np.where(np.arange(1200)[:, None] % 2, np.roll(x, 1, axis=0), rng.normal(size=x.shape))
    other -= (other * x).sum(1)[:, None] * x
    other /= np.linalg.norm(other, axis=1)[:, None]
    x = np.concatenate((x, 0.902 * x + np.sqrt(1 - 0.902**2) * other))
    n, _ = brute_links(np.arange(len(x)), x)
    schema = SCHEMA.replace("float", "double")
    got = itq.similarity_links(frame(spark, list(enumerate(x.tolist())), schema)).orderBy("vec_id").collect()
    found = np.array([r["n_links"] for r in got])
    assert (found <= n).all() and found.sum() >= 0.96 * n.sum()


def test_op4_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    n, component = brute_links(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64))
    got = queries.QUERIES["op4_itq_near_duplicates"](spark, SF_SMALL).orderBy("vec_id").collect()
    assert [r["n_links"] for r in got] == n.tolist() and [r["component_id"] for r in got] == component.tolist()


# ---------------------------------------------------------------- 6: top-k


def brute_top(ids, values, asks, k):
    out = []
    for i in np.flatnonzero(asks):
        score = values @ values[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out += [(int(ids[i]), r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(16_384, 512), (40, 3)])
def test_top_k(spark, sizes):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16)) * 0.2
    x[50:80] = x[49]  # ties
    x[100] = 0
    ids = rng.permutation(1000)[:300]
    rows = list(zip(ids.tolist(), x.tolist()))
    schema = SCHEMA.replace("float", "double")
    got = topk.top_k(frame(spark, rows, schema), F.col("_id") % 7 == 0, 5, 256, candidates_per_block=sizes[0], queries_per_block=sizes[1])
    values = np.floor(x * 256).astype(np.int64)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == brute_top(ids, values, ids % 7 == 0, 5)


def test_bit_slices_bound_holds_whatever_is_cut():
    rng = np.random.default_rng(3)
    values = rng.integers(-300, 300, (130, 9))
    ids = np.arange(130)
    for low in (0, 1, 2, 5):
        index = topk.BitSlices(values, low)
        for query in (*rng.integers(-300, 300, (5, 9)), np.zeros(9, np.int64)):
            rows = set(index.contenders(query, 4, index.inside).tolist())
            assert set(np.lexsort((ids, -(values @ query)))[:4].tolist()) <= rows


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (7, None), (8, [NAN, 1.0]), (9, [1.0, None]), (10, []), (0, [1.0, 0.0]), (None, [1.0, 1.0]), (11, [-1.0])]
    got = topk.top_k(frame(spark, rows), F.col("_id") % 50 == 0, 5, 256).collect()
    assert sorted(tuple(r) for r in got) == [
        (0, 1, 50, 32768), (0, 2, 10, 0), (0, 3, 11, -65536),
        (50, 1, 0, 32768), (50, 2, 10, 0), (50, 3, 11, -32768),
    ]
    assert topk.top_k(frame(spark, []), F.col("_id") % 50 == 0, 5, 256).count() == 0
    with pytest.raises(ValueError, match="beyond"):
        topk.top_k(frame(spark, [(0, [1e9])]), F.col("_id") % 50 == 0, 5, 256)
