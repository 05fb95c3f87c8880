"""Hard negatives by segment summaries against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm import hard_negatives

SCHEMA = "vec_id long, label int, v array<double>"


def brute(rows, step, positives=5, negatives=10, low=30, high=90):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    score = lambda a, b: int(sum(x * y for x, y in zip(a[2], b[2])))
    order = lambda pair: (-pair[0], pair[1][0] is None, pair[1][0] or 0)
    made = []
    for i, a in enumerate(rows):
        if a[0] is None or a[0] % step:
            continue
        scored = [(score(a, b), b) for j, b in enumerate(rows) if j != i]
        for p, b in sorted((x for x in scored if x[1][1] == a[1]), key=order)[:positives]:
            hard = sorted((x for x in scored if x[1][1] != a[1] and low * p <= 100 * x[0] <= high * p), key=order)[:negatives]
            made += [(a[0], b[0], k, n[0], p, s) for k, (s, n) in enumerate(hard, 1)]
    return sorted(made, key=str)


def found(spark, rows, step, **settings):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % step == 0, **settings).collect()), key=str)


@pytest.mark.parametrize("kind", ["plain", "clustered", "ties"])
def test_equal_to_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 90)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 5)
    r = np.random.default_rng(3)
    centres = r.normal(0, 60, (4, 12)) * (kind == "clustered")
    rows = [
        (i, int(r.integers(3)), np.floor(centres[i % 4] + r.normal(0, 1.5 if kind == "ties" else 40, 12)).tolist()) for i in range(400)
    ]
    assert found(spark, rows, 10) == brute(rows, 10)


def test_messy_vectors(spark):
    base = [3.0, 1.0, 2.0]
    rows = [
        (0, 1, base), (0, 1, base), (20, 1, base), (1, 1, [3.0, 1.0, 1.0]), (2, 2, [2.0, 1.0, 0.0]), (3, 2, [2.0, 1.0]),
        (None, 1, base), (None, 2, [2.0, 1.0, 0.0]), (4, None, base), (5, 2, None), (6, 2, []), (7, 2, [-3.0, -1.0, -2.0]), (40, 3, [0.0, 0.0, 0.0]),
    ]
    assert found(spark, rows, 20) == brute(rows, 20)
    assert found(spark, [], 20) == []
    assert found(spark, [(1, 1, base)], 20) == []


def test_null_and_non_finite_components_are_told(spark):
    rows = [(1, [1.0, 2.5]), (2, [1.0, None]), (3, None), (4, [float("nan")]), (5, [float("inf")]), (6, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    fine = frame.where(hard_negatives.is_whole(F.col("embedding"))).select("vec_id", hard_negatives.whole_components(F.col("embedding")))
    assert sorted(map(tuple, fine.collect())) == [(1, [256.0, 640.0]), (6, [])]


def test_bounds_hold_and_prune():
    r = np.random.default_rng(0)
    centres = r.normal(0, 100, (20, 32))
    matrix = np.floor(centres[r.integers(20, size=2000)] + r.normal(0, 10, (2000, 32)))
    axes = hard_negatives.principal_axes(matrix)
    held, asked = hard_negatives.Summaries(matrix, axes), hard_negatives.Summaries(matrix[:40], axes)
    every = np.arange(2000)
    exact = matrix[:40] @ matrix.T
    for level in range(len(held.levels)):
        low, high = held.bounds(level, asked, slice(0, 40), every)
        assert (low <= exact).all() and (exact <= high).all()
    found, scored = held.best(asked, slice(0, 40), np.ones((40, 2000), bool), every, 5, [[(-np.inf, np.inf)]] * 40)
    for q in range(40):
        order = np.lexsort((every, -exact[q]))[:5]
        assert found[q][0][0].tolist() == order.tolist()
    # of 80,000 products all but a few are settled by their bounds
    assert scored < 8_000
