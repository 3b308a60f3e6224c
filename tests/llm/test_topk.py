"""Exact top-k against scoring every pair."""

import math

import numpy as np
import pytest

from packetmill.llm import topk


def plain(rows, k, is_query):
    out, good = [], []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            good.append((i, [math.floor(64 * float(np.float32(c))) for c in v]))
    for q, x in good:
        if q is None or not is_query(q):
            continue
        products = ((i, sum(a * b for a, b in zip(x, y))) for i, y in good if i != q and len(y) == len(x))
        scored = sorted((-max(-2**63, min(2**63 - 1, p)), i is None, i or 0, i) for i, p in products)
        out += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out, key=str)


def vectors(n=700, d=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    rows = [(i, [float(np.float32(x)) for x in (centres[i % 5] + rng.normal(size=d) * 0.2)]) for i in range(n)]
    return rows + [(n + i, [1.0] * d) for i in range(90)]  # a very common vector: ties


ODD = [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (2080, []), (2100, []), (2120, [0.5] * 3),
       (None, [1.0] * 8), (None, [2.0] * 8), (40, [0.25] * 8), (20, [1.0] * 8), (2140, [3e18] * 8), (2160, [-3e18] * 8)]


@pytest.mark.parametrize("options", [{}, {"shard": 60, "block": 7}])
def test_against_all_pairs(spark, options):
    rows = vectors() + ODD
    rows += [rows[40], rows[41], rows[41], rows[710]]  # a query and candidates that repeat
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string")
    got = topk.top_k(df, 20, lambda c: c % 20 == 0, **options)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 20, lambda q: q % 20 == 0)


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema), 20, lambda c: c % 20 == 0).collect() == []
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, schema), 20, lambda c: c % 20 == 0).orderBy("rank").collect()] == [
        (0, 1, 1, 64 * 128), (0, 2, 2, 64 * 128)]


def test_tree_bounds_and_pruning():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(3000, 3)) * 64 + 300 * rng.integers(0, 2, (3000, 1)))
    tree = topk.BallTree(x, 32)
    assert sorted(tree.order) == list(range(3000))
    q = rng.normal(size=(5, 3)) * 64
    for node in range(len(tree.start)):
        mine = x[tree.order[tree.start[node]:tree.end[node]]]
        bound = q @ tree.centre[node] + np.sqrt((q ** 2).sum(1)) * tree.radius[node]
        assert ((mine @ q.T).max(0) <= bound + 1e-6).all()
    opened = []
    real = topk.products

    def counted(a, b):
        opened.append(a.shape[0] * b.shape[0])
        return real(a, b)

    topk.products = counted
    try:
        topk.search(tree, x, np.arange(3000), np.floor(q), np.full(5, -1), np.full(5, -math.inf), 10)
    finally:
        topk.products = real
    assert sum(opened) < 0.5 * 5 * 3000  # most vectors are never looked at
