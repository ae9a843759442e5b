import math
import random

from pyspark.sql import functions as F

from fleetbook.llm import topk


def brute(rows, k, every):
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        v = min(w for i, w in rows if i == q)
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, k, every):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, rank int, shard string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k).collect())


def vectors(n, d, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) if rng.random() < 0.7 else 0.0 for _ in range(d)]) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "FIRST_ROWS", 9)
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "PROBE_TERMS", 3)
    same = [0.5, -0.25, 1.0, 0.0, 0.125, 2.0, -1.0, 0.3, 0.0, 0.1]
    rows = vectors(150, 10, 1) + [(i, same) for i in range(200, 260)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 10), (303, [float("inf")] * 10),
             (320, [1.0, 2.0]), (340, []), (None, same), (7, [9.0] * 10), (7, [9.0] * 10), (260, [0.0] * 10)]
    for k in (3, 20):
        assert run(spark, rows, k, 20) == brute(rows, k, 20)


def test_fewer_than_k_and_empty(spark):
    rows = vectors(4, 3, 2)
    assert run(spark, rows, 20, 2) == brute(rows, 20, 2)
    assert run(spark, rows[1:2], 20, 2) == []
    assert run(spark, [], 20, 2) == []


def test_large_scores_stay_exact(spark):
    rows = [(i, [float(2**21 + i), float(-(2**20) - 3 * i), 3.0]) for i in range(30)]
    assert run(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_one_id_in_a_third_of_the_rows_is_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    rows = vectors(200, 6, 9) + [(7, [1.0, 0.5, 0.0, 2.0, 1.0, 0.0])] * 100
    assert run(spark, rows, 20, 20) == brute(rows, 20, 20)
