"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from fleetbook.registry import ORACLE, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, f"{name} has no oracle"
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0
    assert set(QUERIES) <= set(e.queries()) and set(ORACLE) <= set(e.oracle_sql())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.fixture()
def scale_like(spark):
    """Plans as on a large cluster: no broadcast by estimate, and AQE told
    to treat every partition as skewed, so sort-merge joins and skew splits
    are what runs."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_query_matches_oracle_with_scale_plans(scale_like, con, name):
    r = compare(scale_like, name, QUERIES[name], ORACLE[name], SF, con)
    assert r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
