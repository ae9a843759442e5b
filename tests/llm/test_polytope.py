import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetbook.llm import polytope

SCHEMA = "vec_id long, embedding array<float>, rank int, at string"


def brute(rows, k, every):
    rows = [(i, np.float32(v).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(v) for _, v in rows), default=0)
    rows = [(i, np.pad(v, (0, width - len(v)))) for i, v in rows]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        mine = min((tuple(v) for i, v in rows if i == q))
        far = {(float(polytope.distance(np.array([mine]), np.array([v]))[0]), i) for i, v in rows if i != q}
        out += [(q, r, i, s) for r, (s, i) in enumerate(sorted(far)[:k], 1)]
    return sorted(out)


def run(spark, rows, k=10, every=10):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in polytope.nearest_neighbours(df, F.col("vec_id") % every == 0, k).collect())


def vectors(n, d, seed, at=0):
    rng = random.Random(seed)
    return [(at + i, [rng.gauss(0, 1) for _ in range(d)]) for i in range(n)]


def recall(got, exact):
    return len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in exact}) / len(exact)


@pytest.mark.parametrize("width", [5, 24, 64])
def test_recall_against_brute_force(spark, width):
    rows = vectors(1200, width, width)
    got, exact = run(spark, rows), brute(rows, 10, 10)
    assert len(got) == len(exact)
    assert recall(got, exact) >= 0.9
    far = {(q, i): s for q, _, i, s in brute(rows, len(rows), 10)}
    assert all(far[q, i] == s for q, _, i, s in got)
    order = [(q, s, i) for q, _, i, s in sorted(got)]
    assert order == sorted(order)


def test_clusters_and_lengths(spark):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [x * (1 + i % 3) + rng.gauss(0, 0.1) for x in centres[i % 12]]) for i in range(1500)]
    assert recall(run(spark, rows), brute(rows, 10, 10)) >= 0.9


def test_one_vector_and_one_id_in_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(polytope, "LEAST_BLOCK", 16)
    rows = vectors(300, 8, 5) + [(i, [1.0] * 8) for i in range(400, 550)] + [(401, [2.0] * 8)] * 150
    got, exact = run(spark, rows), brute(rows, 10, 10)
    assert recall(got, exact) >= 0.9 and len(got) == len(exact)
    hot = [r for r in got if 400 <= r[0] < 550]
    assert hot == [r for r in exact if 400 <= r[0] < 550]  # ties to the smaller id


def test_few_rows_are_all_found(spark):
    rows = vectors(7, 6, 6)
    assert run(spark, rows) == brute(rows, 10, 10)
    far = vectors(30, 6, 7) + [(100, [1e30, 0.0, 0.0, 0.0, 0.0, 0.0]), (110, [1e-30] * 6)]
    assert len(run(spark, far)) == len(brute(far, 10, 10))


def test_unusable_rows(spark):
    rows = vectors(25, 4, 8) + [(30, None), (40, [1.0, None]), (50, [float("nan")] * 4), (60, [float("inf")] * 4),
                                (70, [0.0] * 4), (80, []), (None, [1.0] * 4), (90, [3.0]), (20, [9.0] * 4)]
    assert run(spark, rows, k=40) == brute(rows, 40, 10)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(10, [1.0])]) == []


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(9, 13))
    x /= np.abs(x).max(1, keepdims=True)
    assert np.allclose(np.linalg.norm(polytope.rotated(x, 0, 0), axis=1), np.linalg.norm(x, axis=1))
