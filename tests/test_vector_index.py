"""Inverted lists against plain cosines: exact with and without a filter, recall of the approximate search, odd rows."""

import numpy as np
import pytest

from palimpsest.operators import vector_index as vi

PLAN = vi.IndexPlan(lists=12, sample=500, group_rows=50, group_queries=3)


def clustered(n, seed, size=16, spread=0.5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, size))
    which = np.where(rng.random(n) < 0.35, 0, rng.integers(0, 8, n))  # a third of all in one place
    return (centers[which] + spread * rng.normal(size=(n, size))).astype(np.float32), which % 3


def plain(x, labels, ids, queries, k, same):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = np.round(u.astype(np.float64) @ u[q].astype(np.float64), 9)
        able = [i for i in range(len(x)) if i != q and (not same or labels[i] == labels[q])]
        out[ids[q]] = [ids[i] for i in sorted(able, key=lambda i: (-s[i], ids[i]))[:k]]
    return out


@pytest.fixture(scope="module")
def rows(spark):
    x, labels = clustered(900, 1)
    frame = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "vec_id long, embedding array<float>, label int")
    return frame, x, labels


@pytest.mark.parametrize("same", [(), ("label",)])
def test_exact(rows, same):
    frame, x, labels = rows
    centroids = vi.fitted(frame, PLAN)
    assert centroids.shape == (12, 16) and np.allclose(np.linalg.norm(centroids, axis=1), 1)
    index = vi.indexed(frame, centroids)
    assert index.count() == 900
    got = {}
    for r in vi.nearest(index, centroids, frame.where("vec_id % 50 = 0"), 7, probes=2, same=same, plan=PLAN).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == plain(x, labels, range(900), range(0, 900, 50), 7, same)


def test_recall_and_filters_that_leave_few(spark, rows):
    frame, x, labels = rows
    centroids = vi.fitted(frame, PLAN)
    index = vi.indexed(frame, centroids)
    q = frame.where("vec_id % 30 = 0")
    exact = spark.createDataFrame([(a, b) for a, found in plain(x, labels, range(900), range(0, 900, 30), 10, ()).items() for b in found], "query_id long, vec_id long")
    some = vi.nearest(index, centroids, q, 10, probes=4, exact=False, plan=PLAN)
    assert vi.recall(some, exact).agg({"recall": "avg"}).first()[0] >= 0.9
    rare = index.where("vec_id % 100 = 7")  # nine rows: fewer than asked for
    out = vi.nearest(rare, centroids, frame.where("vec_id = 0"), 20, probes=1, plan=PLAN).collect()
    assert sorted(r.vec_id for r in out) == list(range(7, 900, 100))


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (None, [1.0, 1.0]), (5, [1.0]), (6, [nan, 1.0]), (7, [0.0, 1.0]), (8, [3.0, 0.0]), (9, [None, 1.0]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "5 AS part", "'x' AS q", "if(vec_id = 7, null, 1) AS label")
    centroids = vi.fitted(frame)
    index = vi.indexed(frame, centroids)
    assert sorted(r.vec_id for r in index.collect()) == [1, 1, 2, 7, 8]
    found = vi.nearest(index, centroids, frame, 2, same=("label",))
    assert sorted((r.query_id, r.vec_id, r["rank"]) for r in found.collect()) == [(1, 2, 1), (1, 8, 2), (2, 1, 1), (2, 1, 2), (8, 1, 1), (8, 1, 2)]
    none = frame.limit(0)
    assert vi.fitted(none).shape == (0, 0) and vi.indexed(none, vi.fitted(none)).collect() == []
    assert vi.nearest(vi.indexed(none, vi.fitted(none)), vi.fitted(none), frame, 2).collect() == []
    assert vi.nearest(index, centroids, none, 2).collect() == []
