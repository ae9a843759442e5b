"""Both sides arriving, their waiting rows in files: the rules of the
stream-stream joins, duplicate keys across batches, retries, and queries that
keep no row in a state store."""

import datetime as dt
import os
import tempfile
from decimal import Decimal as D
from functools import partial

import pytest
from pyspark.sql import functions as F

from fleetbook.registry import QUERIES
from fleetbook.sources.tables import table_path
from fleetbook.streaming import arrivals
from fleetbook.streaming.payments import run_foreach_batch

PAY = "pid long, reservation_id long, amount_paid decimal(12,2), paid_at timestamp"
RES = "reservation_id long, tot_amount decimal(12,2), made_at timestamp"
HOW = {"wait": "10 days", "delay": "2 days", "salt_by": "pid"}


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def writer(base):
    cap = partial(arrivals.capped_on_arrival, pay_time="paid_at", res_time="made_at", **HOW)
    return arrivals.ArrivalWriter(cap, f"{base}/out", f"{base}/state", key="reservation_id",
                                  left_time="paid_at", right_time="made_at", **HOW)


def arrive(spark, base, payments, reservations):
    for name, rows, schema in (("p", payments, PAY), ("r", reservations, RES)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
    both = arrivals.both_sides(spark.readStream.schema(PAY).parquet(f"{base}/p"), spark.readStream.schema(RES).parquet(f"{base}/r"))
    run_foreach_batch(both, writer(base), f"{base}/ckpt")
    return sorted((r.pid, r.amount_paid) for r in spark.read.schema(PAY).parquet(f"{base}/out").collect())


def test_payments_wait_in_files_for_their_reservations(spark):
    base = tempfile.mkdtemp(prefix="fb-writer-", dir="/tmp")
    early = [(1, 7, D(90), day(3)), (2, 8, D(5), day(3)), (3, 99, D(50), day(1))]
    assert arrive(spark, base, early, [(5, D(1), day(2))]) == []
    got = arrive(spark, base, [(4, 7, D(10), day(5)), (5, 7, D(70), day(5))], [(7, D(60), day(4)), (8, D(60), day(5))])
    assert got == [(1, D(60)), (2, D(5)), (4, D(10)), (5, D(60))]
    # a second reservation of an id meets the payments that met the first, as in a stream-stream join
    got = arrive(spark, base, [(6, 50, D(9), day(6))], [(7, D(20), day(6))])
    assert got == [(1, D(20)), (1, D(60)), (2, D(5)), (4, D(10)), (4, D(10)), (5, D(20)), (5, D(60))]
    # the watermark passes: those that met nothing are handed on, the late one and the one without a time are not
    got = arrive(spark, base, [(7, 8, D(9), day(1)), (8, 8, D(9), None), (9, None, None, day(400))], [(-1, None, day(400))])
    assert got == [(1, D(20)), (1, D(60)), (2, D(5)), (3, D(50)), (4, D(10)), (4, D(10)), (5, D(20)), (5, D(60)), (6, D(9))]
    # only the versions that a retry can need stay, and the last keeps the rows that may still meet
    assert sorted(os.listdir(f"{base}/state")) == ["batch_id=2", "batch_id=3"]
    assert [r.pid for r in spark.read.parquet(f"{base}/state/batch_id=3/left").collect()] == [9]


def test_a_retried_batch_writes_the_same_and_a_lost_state_is_an_error(spark):
    base = tempfile.mkdtemp(prefix="fb-retry-", dir="/tmp")

    def batch(payments, reservations):
        return arrivals.both_sides(spark.createDataFrame(payments, PAY), spark.createDataFrame(reservations, RES))

    handler = writer(base)
    handler(batch([(1, 7, D(90), day(3))], [(8, D(1), day(3))]), 0)
    for _ in range(2):
        handler(batch([(2, 8, D(90), day(4))], [(7, D(60), day(4))]), 1)
        got = sorted((r.pid, r.amount_paid) for r in spark.read.schema(PAY).parquet(f"{base}/out").collect())
        assert got == [(1, D(60)), (2, D(1))]
    with pytest.raises(RuntimeError, match="no state"):
        handler(batch([(3, 8, D(90), day(4))], [(7, D(60), day(4))]), 9)


def test_arrival_queries_keep_no_row_in_a_state_store(spark, monkeypatch):
    """A state store needs several point accesses a row (F1, F2)."""
    from fleetbook import registry

    d, seen = tempfile.mkdtemp(prefix="fb-nostore-", dir="/tmp"), []
    at = F.lit("1995-06-01").cast("timestamp_ntz")
    keys = spark.range(40)
    keys.select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                (F.col("id") * 10.0).alias("o_totalprice"), at.alias("o_orderdate"),
                F.lit("5-LOW").alias("o_orderpriority")).write.parquet(table_path(d, "orders"))
    keys.select((F.col("id") % 45).alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
                F.lit(1).alias("l_linenumber"), *(F.lit(100.0).alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")),
                F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), at.alias("l_shipdate")
                ).write.parquet(table_path(d, "lineitem"))
    keys.select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("ECONOMY").alias("p_type"),
                F.lit(1).alias("p_size"), F.lit(3.0).alias("p_retailprice")).write.parquet(table_path(d, "part"))
    scratch = registry.scratch_path
    monkeypatch.setattr(registry, "scratch_path", lambda s, n: seen.append(scratch(s, n)) or seen[-1])
    capped = QUERIES["stream_cap_on_arrival"](spark, d).collect()
    assert {r.reservation_id: r.amount_paid for r in capped} == {i: min(D(10 * i), D(100)) for i in range(40)}
    assert QUERIES["stream_price_on_arrival"](spark, d).count() == 40
    assert len(seen) == 2
    for base in seen:
        assert os.path.isdir(f"{base}/checkpoint") and not os.path.exists(f"{base}/checkpoint/state")
