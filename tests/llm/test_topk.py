"""Exact top-k against a full product."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import topk

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    clean = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in clean), default=0)
    grid = {n: np.floor(1024 * np.array(list(v) + [0.0] * (width - len(v)), np.float32).astype(float)).astype(int) for n, (_, v) in enumerate(clean)}
    out = []
    for n, (q, _) in enumerate(clean):
        if asked(q):
            found = sorted((-int(grid[n] @ grid[m]), i) for m, (i, _) in enumerate(clean) if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def run(spark, rows, k=10, asked=lambda q: q % 7 == 0):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], DDL).repartition(3)
    df = df.withColumns({"_id": F.lit("x"), "_v": F.lit("x"), "rb": F.lit(1), "score": F.lit(2)})
    got = topk.top_k(df, df.where("vec_id % 7 = 0"), k).collect()
    assert sorted(map(tuple, got)) == brute(rows, asked, k)


def vectors(n, d, seed, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[3][1]) for i in range(copies)]


def test_random_vectors_and_many_ties(spark):
    run(spark, vectors(400, 16, 1, copies=60))


def test_blocks_and_tight_bounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 50)
    monkeypatch.setattr(topk, "QUERIES", 9)
    run(spark, vectors(300, 8, 2, copies=20), k=4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 4, 3) + [(None, [1.0] * 4), (70, None), (77, [nan, 0.0, 0.0, 0.0]), (84, [inf] * 4), (91, [None, 1.0]), (98, []), (105, [1.0])]
    run(spark, rows)
    run(spark, vectors(5, 4, 4))
    run(spark, vectors(1, 4, 5))
    empty = spark.createDataFrame([], DDL)
    assert topk.top_k(empty, empty).count() == 0


def test_large_components_are_exact_or_refused(spark):
    run(spark, [(7 * i, [float(i * 3_000), -1.0, 0.5]) for i in range(12)])
    for huge in (1e30, 3e8):
        df = spark.createDataFrame([(i, [huge, float(i)], 0) for i in range(3)], DDL)
        with pytest.raises(Exception, match="not exact"):
            topk.top_k(df, df, 2).collect()


def test_proof_leaves_few_rows_and_loses_none():
    rng = np.random.default_rng(6)
    v = np.floor(1024 * rng.normal(size=(3_000, 32)) / 6).astype(int)
    index = topk.ImpactIndex(np.arange(3_000), v)
    for q in range(20):
        possible = index._possible(v[q], 10, np.arange(3_000) != q)
        score = v @ v[q]
        score[q] = -(1 << 60)
        assert possible[np.argsort(-score)[:10]].all() and possible.sum() < 1_000
