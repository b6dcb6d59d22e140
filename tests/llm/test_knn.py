"""Exact top-k against all products."""

import numpy as np
import pytest

from scarmap.llm import knn as N


def brute(rows, k=10, every=100):
    ints = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            ints.append((i, [int(np.floor(1024 * float(x))) for x in v]))
    out = []
    for q, a in ints:
        if q % every == 0:
            scored = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, every=100, **more):
    data = N.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    return sorted(tuple(r) for r in N.top_k(data.where(f"vec_id % {every} = 0"), data, **more).collect())


def clusters(n, seed=0, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    return [(i, (centres[rng.integers(8)] * rng.uniform(0.2, 2) + rng.normal(size=size) * 0.1).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"pivots": 5, "group_queries": 3, "part_rows": 50}, {"pivots": 40, "group_queries": 2, "part_rows": 7, "k": 3}])
def test_all_products(spark, monkeypatch, more):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "BLOCK_QUERIES", 2)
    rows = clusters(400)
    assert run(spark, rows, 20, **more) == brute(rows, more.get("k", 10), 20)


def test_rows_far_from_all_queries_are_not_moved():
    space = N.Space(2, 100.0, np.array([[10.0, 0, 0], [-10.0, 0, 0]]), True)
    d = space.distances(space.lift(np.array([[9, 1], [-9, 1]])))
    q = space.distances(space.stretch(np.array([[3, 0]])))
    assert q[0, 0] == pytest.approx(0) and d[0, 0] < 7 < 15 < d[1, 0]


def test_ties_copies_and_odd_vectors(spark):
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot) for i in range(60)] + [(100, [0.0, 0.0, 0.0]), (200, [-1.0, -1.0, -1.0]), (300, None), (301, [1.0, None, 2.0]), (302, [1.0, float("nan"), 2.0]), (303, [float("inf"), 0.0, 0.0])]
    rows += [(None, hot), (304, [1.0]), (305, []), (7, hot), (400, [2.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, part_rows=9, group_queries=1) == brute(rows)


def test_repeated_queries_few_rows_and_large_numbers(spark):
    got = run(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0])])
    assert got == [(0, 1, 1, 2 * 1024 * 1024)] * 2
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0])]) == []
    rows = [(0, [3e5, 1.0]), (1, [3e5, 2.0]), (2, [3e5, 1.0 + 1 / 1024]), (3, [-3e5, 7.0])]
    assert run(spark, rows) == brute(rows)
