"""Arrival order with NULLs, state of the one-time offers, streams over tables
of one file and of many, and the default overdue rule."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.cli import main
from fleetbook.operators import pricing, queries
from fleetbook.plans.aggregates import pick_per_group
from fleetbook.registry import QUERIES
from fleetbook.session import scratch_path, scratch_scope
from fleetbook.sources.catalog import register_tables
from fleetbook.sources.tables import path_exists, rows_frame, table_path
from fleetbook.streaming import promos

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_order_is_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1, 1), ("a", 5, 1, 3), ("a", 4, None, 4), ("b", None, None, 9), ("b", None, None, 8), ("c", 2, 2, 7)],
        "g string, o int, p int, v int")
    assert dict(rows(pick_per_group(df, "g", ["o"], "v"))) == {"a": 4, "b": 8, "c": 7}
    assert dict(rows(pick_per_group(df, "g", ["o"], "v", last=True))) == {"a": 3, "b": 9, "c": 7}
    assert dict(rows(pick_per_group(df, "g", ["p", "o"], "v"))) == {"a": 3, "b": 8, "c": 7}
    assert dict(rows(pick_per_group(df, "g", ["p", "o"], "v", last=True))) == {"a": 3, "b": 9, "c": 7}


def test_sole_user_without_a_date_gets_the_offer(spark):
    offers = rows_frame(spark, [("X", None, 5, "Y", "Available")], T.StructType([
        T.StructField("promo_code", T.StringType()), T.StructField("percentage", T.IntegerType()),
        T.StructField("discounted_amount", T.IntegerType()), T.StructField("is_one_time", T.StringType()),
        T.StructField("status", T.StringType())]))
    res = spark.createDataFrame([(1, None, "X", 100)], "reservation_id int, start_date date, promo_code string, tot_amount int")
    got = pricing.price_total(res, offers, ["start_date"], parts=("tot_amount",)).select("tot_amount").first()[0]
    assert got == 95


def test_stream_of_a_null_time_uses_the_code_once(spark):
    base = tempfile.mkdtemp(prefix="fb-null-", dir="/tmp")
    schema = "rid bigint, ts timestamp, code string"
    handler = promos.OneTimeOfferUse(f"{base}/out", f"{base}/state", ["ts"], key="rid", code="code")
    day = dt.datetime(2024, 1, 1)
    for batch in ([(1, None, "A"), (2, None, "B"), (3, day, "B"), (None, day, "C")], [(4, day, "A"), (5, day, "C")], [(6, day, "A")]):
        spark.createDataFrame(batch, schema).write.parquet(f"{base}/src", mode="append")
        promos.run_batches(spark.readStream.schema(schema).parquet(f"{base}/src"), handler, f"{base}/ckpt")
    got = {r.rid: r.promo_available for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: 1, 2: 0, 3: 1, None: 0, 4: 0, 5: 1, 6: 0}
    # only the versions that a retry can need stay
    assert [path_exists(spark, f"{base}/state/batch_id={i}") for i in range(3)] == [False, True, True]
    with pytest.raises(RuntimeError, match="no state"):
        handler(spark.createDataFrame([(9, day, "A")], schema), 9)


@pytest.mark.parametrize("name", ["stream_cap_payments", "stream_one_time_promo", "stream_price_rentals"])
def test_stream_keys_on_folder_tables(spark, name):
    d = tempfile.mkdtemp(prefix="fb-folder-", dir="/tmp")
    for t in ("events", "customer", "lineitem", "orders", "part"):
        spark.read.parquet(table_path(SF, t)).repartition(3).write.parquet(table_path(d, t))
    assert rows(QUERIES[name](spark, d)) == rows(QUERIES[name](spark, SF))


def test_a_rental_due_today_is_overdue_by_default(spark, seed):
    res = spark.createDataFrame([(i, "Reserved") for i in range(3)], "reservation_id int, status string").select(
        "*", F.date_add(F.current_date(), F.col("reservation_id") - 1).alias("end_date"),
        F.lit(None).cast("date").alias("actual_end_date"))
    assert [r[0] for r in rows(queries.overdue_reservations(res))] == [0, 1]
    today = res.select(F.current_date()).first()[0]
    assert [r[0] for r in rows(queries.overdue_reservations(res, today))] == [0]

    src, dst = (tempfile.mkdtemp(prefix=f"fb-{x}-", dir="/tmp") for x in ("src", "dst"))
    (seed["reservation"].withColumn("status", F.lit("Reserved")).withColumn("end_date", F.current_date())
     .withColumn("actual_end_date", F.lit(None).cast("date"))).write.parquet(table_path(src, "reservation"))
    seed["car_user"].write.parquet(table_path(src, "car_user"))
    main(["overdue-report", "--src", src, "--dst", dst], spark)
    assert spark.read.text(f"{dst}/overdue_report").count() == seed["reservation"].count()


def test_register_tables_asks_the_file_system(spark, seed):
    src = tempfile.mkdtemp(prefix="fb-reg-", dir="/tmp")
    seed["car"].write.parquet(table_path(src, "car"))
    assert set(register_tables(spark, src)) == {"car"}
    assert set(register_tables(spark, f"file://{src}", ["car"])) == {"car"}
    with pytest.raises(FileNotFoundError):
        register_tables(spark, src, ["car", "payment"])


def test_lookup_by_amount(spark):
    res = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "reservation_id int, tot_amount int")
    pay = spark.createDataFrame([(2, 10), (3, 20), (9, 30), (5, 40), (6, 40)], "reservation_id int, amount_paid int")
    assert [r[0] for r in rows(queries.exactly_paid_reservations(res, pay))] == [2, 3]
    twice = pay.union(spark.createDataFrame([(1, 10)], pay.schema))
    assert [r[0] for r in rows(queries.exactly_paid_reservations(res, twice, on_many="min"))] == [1, 3]
    with pytest.raises(Exception, match="more than one payment matches amount"):
        queries.exactly_paid_reservations(res, twice).collect()


def test_scratch_scope_leaves_nothing(spark):
    with scratch_scope(spark) as root:
        path = scratch_path(spark, "side")
        spark.range(3).write.parquet(path)
        assert path.startswith(root) and path_exists(spark, path)
    assert not path_exists(spark, root)
