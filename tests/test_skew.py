"""Hot keys: one promo code and one reservation hold a third of the rows.
Results must equal a brute-force computation, with AQE forced to split
skewed partitions."""

import datetime as dt
import random
import re
from decimal import Decimal as D

import pytest

from fleetbook.operators import pricing, queries, settlement
from fleetbook.sources.tables import rows_frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

N = 3000


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
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


def _data(spark):
    rnd = random.Random(7)
    codes = ["HOT"] * (N // 3) + [rnd.choice(["A", "B", "C", None]) for _ in range(N - N // 3)]
    rnd.shuffle(codes)
    res_rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(60)), codes[i],
                 "Reserved" if i % 2 else "Completed", D(rnd.randrange(100, 300)))
                for i in range(N)]
    res = spark.createDataFrame(res_rows, "reservation_id int, start_date date, "
                                "promo_code string, status string, tot_amount decimal(8,2)")
    pay_rows = [(j, 7 if j < N // 3 else rnd.randrange(N), D(rnd.randrange(1, 200)))
                for j in range(N)]
    pay = spark.createDataFrame(pay_rows, "payment_id int, reservation_id int, "
                                "amount_paid decimal(8,2)")
    offers = rows_frame(spark, [("HOT", "Y", "Available"), ("A", "N", "Available"),
                                ("B", "Y", "Expired")],
                        T.StructType([T.StructField("promo_code", T.StringType()),
                                      T.StructField("is_one_time", T.StringType()),
                                      T.StructField("status", T.StringType())]))
    return res_rows, pay_rows, res, pay, offers


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _hot(spark, columns, n=N):
    """``n`` rows (key, second, id): a third has key 7 and second 70."""
    rnd = random.Random(5)
    rows = [(7, 70, i) if i < n // 3 else (rnd.randrange(1000, 1400), rnd.randrange(50), i) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))


def test_hot_keys_are_split(skew_conf):
    """A third of the rows on one key: the final plan splits it."""
    from fleetbook.operators import integrity
    from fleetbook.plans.joins import small_side

    spark = skew_conf
    cars = _hot(spark, ["vin", "car_type", "car_id"])
    res = _hot(spark, ["vin", "license_no", "reservation_id"])
    types = spark.createDataFrame([(i, 100) for i in range(80)], "car_type int, price_per_day int")
    rented = queries.rented_types_over_price(types, cars, res, 85)
    assert "skew=true" in _final_plan(rented)

    child = _hot(spark, ["a", "b", "id"])
    parent = small_side(_hot(spark, ["a", "b", "id"]).select("a", "b").distinct())
    bad = integrity.check_foreign_key(child, parent, ["a", "b"], ["a", "b"])
    assert "skew=true" in _final_plan(bad)

    lines = res.select("vin", F.lit("Basic").alias("insurance_type"), "reservation_id",
                       F.lit(dt.date(2020, 1, 1)).alias("start_date"), F.lit(dt.date(2020, 1, 9)).alias("actual_end_date"))
    one = spark.createDataFrame([(v, 1, 10) for v in [7, *range(1000, 1400)]], "vin int, car_type int, price_per_day int")
    rates = rows_frame(spark, [(1, "Basic", 3)], T.StructType([
        T.StructField("car_type", T.IntegerType()), T.StructField("insurance_type", T.StringType()),
        T.StructField("insurance_price", T.IntegerType())]))
    cars_table = small_side(one)
    assert "skew=true" in _final_plan(pricing.rent_and_insurance(lines, cars_table, rates))


def test_popular_amount_gathers_no_reservations(skew_conf):
    spark = skew_conf
    res = _hot(spark, ["tot_amount", "license_no", "reservation_id"])
    pay = _hot(spark, ["amount_paid", "x", "reservation_id"])
    plan = _final_plan(queries.exactly_paid_reservations(res, pay, on_many="min"))
    # rows meet by the pair; amounts alone key partial aggregates only
    for keys in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan):
        assert "tot_amount" not in keys or "reservation_id" in keys


def test_hot_keys_match_brute_force(skew_conf):
    spark = skew_conf
    res_rows, pay_rows, res, pay, offers = _data(spark)

    firsts = {r[0]: r[1] for r in pricing.first_uses(res, offers, ["start_date"]).collect()}
    expect = {c: min((r[1], r[0]) for r in res_rows if r[2] == c)[1] for c in ("HOT", "B")}
    assert firsts == expect

    usage = dict(tuple(r) for r in queries.promo_usage(offers, res).collect())
    assert usage == {"A": sum(1 for r in res_rows if r[2] == "A")}

    paid = {}
    for _, rid, amt in pay_rows:
        paid[rid] = paid.get(rid, 0) + amt
    due = {r[0] for r in res_rows if r[3] == "Reserved" and r[0] in paid and r[4] <= paid[r[0]]}
    got = {r[0] for r in settlement.due_reservations(res, pay).select("reservation_id").collect()}
    assert got == due

    totals = {r[0]: r[4] for r in res_rows}
    capped = {r[0]: r[1] for r in pricing.cap_payment(pay, res).select(
        "payment_id", "amount_paid").collect()}
    assert capped == {j: min(a, totals[rid]) if rid in totals else a for j, rid, a in pay_rows}

    joined = queries.join_payments(res, pay).count()
    assert joined == sum(1 for _, rid, _ in pay_rows if rid in totals)
