"""Label model and scorer: recovery of known accuracies, held-out accuracy on
labelled documents, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from fleetbook.llm import quality as q
from fleetbook.llm.common import read


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, k = 60_000, len(q.LABELLERS)
    truth = rng.choice(3, n, p=[0.8, 0.12, 0.08])
    votes = np.full((n, k), q.GOOD)
    for i in range(k):
        wrong = np.where(truth == q.FAULTS[i], 0.8, 0.03)
        votes[:, i] = np.where(rng.random(n) < wrong, q.BAD, q.GOOD)
    votes[rng.random((n, k)) < 0.1] = q.NONE
    rows, counts = np.unique((votes * 3 ** np.arange(k)).sum(1), return_counts=True)
    model = q.fit_labels(rows, counts.astype(float))
    assert np.allclose(model.shares, [0.8, 0.12, 0.08], atol=0.01)
    for i in range(k):
        assert abs(model.tables[q.FAULTS[i], i, q.BAD] - 0.8) < 0.03
        assert abs(model.tables[q.GOOD_CLASS, i, q.BAD] - 0.03) < 0.01
    good = model.posterior((votes * 3 ** np.arange(k)).sum(1)) > 0.5
    assert (good == (truth == 0)).mean() > 0.97


def test_held_out_accuracy_on_labels(spark):
    """The labels take no part in training."""
    sf = "/root/testdata/sf0.01"
    got = q.classify(read(spark, sf, "documents")).join(read(spark, sf, "labels"), "doc_id")
    bad, clean = (got.where(F.col("quality") == v).agg(F.avg(F.col("kept").cast("int"))).first()[0] for v in (0, 1))
    assert bad < 0.1 and clean > 0.97


def test_edge_rows_and_pass_through(spark):
    prose = "The quick brown fox saw a lazy dog near the old mill. It ran home, then slept until noon. "
    rows = [(i, f"{prose} Line {i} was said by someone else.", "a", 1.0) for i in range(60)]
    rows += [(100 + i, "WORD!! " * 60 + f"X{i}", "a", 1.0) for i in range(20)]
    rows += [(200, None, "a", 1.0), (201, "", "a", 1.0), (202, " \n\t", "a", 1.0), (None, prose, "a", 1.0), rows[0],
             (203, prose * 2000, "a", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, votes string, score double")
    got = q.classify(docs).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(got) == len(rows) and {*range(60), None} <= kept
    assert not kept & {*range(100, 120), 200, 201, 202}
    assert all(r.posterior == r.score == 0 for r in got if r.doc_id in (200, 201, 202))
    passed = q.keep_good(docs)
    assert passed.columns == docs.columns
    assert sorted(map(str, passed.collect())) == sorted(
        str(r) for r in docs.collect() if r.doc_id in kept)


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([(1, "")], "doc_id long, text string")
    assert [r.kept for r in q.classify(docs).collect()] == [False]
    assert q.classify(docs.where("false")).count() == q.keep_good(docs.where("false")).count() == 0


def test_a_repeated_id_does_not_fill_the_sample(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    plain = {r.doc_id: r.kept for r in q.classify(docs).collect()}
    first = docs.where(F.length("text") > 200).orderBy(F.xxhash64("doc_id"), "doc_id").limit(1)
    copies = first.crossJoin(spark.range(q.SAMPLE_ROWS + 500)).select(docs.columns)
    again = q.classify(docs.union(copies)).select("doc_id", "kept").distinct().collect()
    changed = sum(plain[r.doc_id] != r.kept for r in again)
    assert len(again) == len(plain) and changed <= 0.01 * len(plain)


def test_features_brought_to_the_driver_are_bounded(spark, monkeypatch):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    seen, fit = [], q.fit_scorer
    monkeypatch.setattr(q, "fit_scorer", lambda rows, labels: (seen.append(rows), fit(rows, labels))[1])
    for bound in (5_000, 1):
        monkeypatch.setattr(q, "SAMPLE_FEATURES", bound)
        q.train(docs)
        assert len(seen[-1]) == 1 or sum(len(at) for at, _ in seen[-1]) <= bound
