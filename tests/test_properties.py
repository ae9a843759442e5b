"""Randomised checks of the plan helpers against plain Python."""

import random

from pyspark.sql import functions as F

from fleetbook.plans.aggregates import pick_per_group
from fleetbook.plans.joins import null_aware_anti_join


def _expected_not_in(left, right):
    if not right:
        return sorted(left, key=lambda v: (v is not None, v))
    if any(v is None for v in right):
        return []
    rs = set(right)
    return sorted(v for v in left if v is not None and v not in rs)


def test_not_in_random(spark):
    rnd = random.Random(11)
    for trial in range(6):
        left = [rnd.choice([None] + list(range(8))) for _ in range(rnd.randrange(0, 12))]
        right = [rnd.choice([None] * (trial % 2) + list(range(8)))
                 for _ in range(rnd.randrange(0, 6))]
        ldf = spark.createDataFrame([(v,) for v in left], "k int")
        rdf = spark.createDataFrame([(v,) for v in right], "k int")
        for mat in (False, True):
            got = [r[0] for r in null_aware_anti_join(ldf, rdf, "k", "k", mat).collect()]
            assert sorted(got, key=lambda v: (v is not None, v)) == _expected_not_in(left, right)


def test_pick_per_group_random(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abc"), rnd.randrange(4), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o int, k int")
    first = dict(tuple(r) for r in pick_per_group(df, "g", ["o"], "k").collect())
    last = dict(tuple(r) for r in pick_per_group(df, "g", ["o"], "k", last=True).collect())
    for g in "abc":
        mine = [(o, k) for gg, o, k in rows if gg == g]
        assert first[g] == min(mine)[1]
        assert last[g] == max(mine)[1]
    two = dict(tuple(r) for r in pick_per_group(df.withColumn("o2", F.col("k") % 3), "g",
                                                ["o", "o2"], "k").collect())
    for g in "abc":
        assert two[g] == min((o, k % 3, k) for gg, o, k in rows if gg == g)[2]
