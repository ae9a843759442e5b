"""Edge rows: NULL logic, ties, duplicate matches, orphans, arrival order."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.functions.scalars import (char_equal, char_pad, concat_null_as_empty,
                                         oracle_pattern, parse_date, round_to_int)
from fleetbook.operators import integrity, pricing, queries, settlement
from fleetbook.plans.joins import bounded_broadcast, null_aware_anti_join
from fleetbook.sources.schemas import SCHEMAS
from fleetbook.sources.tables import append_rows


def rows(df, *cols):
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda t: tuple((v is not None, v) for v in t))


def test_equal_amounts_make_the_scalar_subquery_fail(spark, seed):
    extra = spark.createDataFrame(
        [(1006, D("129.65"), None, None, None, None, None, 2, None, None, "Y")], SCHEMAS["payment"])
    pay = seed["payment"].unionByName(extra)
    with pytest.raises(Exception, match="more than one payment"):
        queries.users_without_exact_payment(seed["car_user"], seed["reservation"], pay).collect()


def test_not_in_three_valued(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    plain = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(null_aware_anti_join(left, with_null, "k", "k")) == []
    assert rows(null_aware_anti_join(left, plain, "k", "k")) == [(2,)]
    assert len(rows(null_aware_anti_join(left, empty, "k", "k"))) == 3


def test_not_in_matches_spark_sql(spark):
    left = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "k int")
    right = spark.createDataFrame([(i,) for i in range(0, 20, 3)], "k int")
    left.createOrReplaceTempView("l_nin")
    right.createOrReplaceTempView("r_nin")
    expect = rows(spark.sql("select k from l_nin where k not in (select k from r_nin)"))
    assert rows(null_aware_anti_join(left, right, "k", "k")) == expect


def test_filter_not_equal_drops_null(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "f string")
    assert rows(queries.filter_not_equal(df, "f", "Y")) == [("N",)]


def _res(spark, rows_):
    schema = T.StructType([
        T.StructField("reservation_id", T.IntegerType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("actual_end_date", T.DateType()),
        T.StructField("vin", T.StringType()),
        T.StructField("penalty_amount", T.DecimalType(8, 2)),
    ])
    return spark.createDataFrame(rows_, schema)


def test_penalty_late_early_same_day(spark):
    d = dt.date
    res = _res(spark, [
        (1, d(2020, 1, 1), d(2020, 1, 5), d(2020, 1, 8), "A", D("7.00")),   # 3 days late
        (2, d(2020, 1, 1), d(2020, 1, 5), d(2020, 1, 3), "A", D("7.00")),   # early: kept
        (3, d(2020, 1, 1), d(2020, 1, 5), None, "A", D("7.00")),            # not back: kept
        (4, d(2020, 1, 1), d(2020, 1, 1), d(2020, 1, 1), "A", None),        # same day: 0
    ])
    got = dict(rows(pricing.penalty_amount(res), "reservation_id", "penalty_amount"))
    assert got == {1: D("150.00"), 2: D("7.00"), 3: D("7.00"), 4: D("0.00")}
    prices = spark.createDataFrame([("A", D("10.00"))], "vin string, price_per_day decimal(8,2)")
    rent = dict(rows(pricing.rent_amount(res, prices), "reservation_id", "rental_amount"))
    assert rent[4] == D("0.00") and rent[3] is None and rent[1] == D("70.00")


def test_unknown_car_gives_null_rent(spark):
    res = _res(spark, [(1, dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 2), "Z", None)])
    prices = spark.createDataFrame([("A", D("10.00"))], "vin string, price_per_day decimal(8,2)")
    assert rows(pricing.rent_amount(res, prices), "rental_amount") == [(None,)]


OFFER_COLS = "promo_code string, is_one_time string, percentage decimal(5,2), " \
             "discounted_amount decimal(8,2), status string"


def test_one_time_offer_used_twice_and_null_flags(spark):
    offers = spark.createDataFrame([
        ("ONCE", "Y", None, D("25"), "Available"),
        ("NULLFLAG", None, D("10"), None, "Available"),
        ("NODISC", "N", None, None, "Available"),
    ], OFFER_COLS)
    res = spark.createDataFrame([
        (1, dt.date(2020, 1, 2), "ONCE", D("100.00")),
        (2, dt.date(2020, 1, 1), "ONCE", D("100.00")),
        (3, dt.date(2020, 1, 3), "NULLFLAG", D("100.00")),
        (4, dt.date(2020, 1, 3), "NODISC", D("100.00")),
        (5, dt.date(2020, 1, 3), "MISSING", D("100.00")),
        (6, dt.date(2020, 1, 3), None, D("100.00")),
    ], "reservation_id int, start_date date, promo_code string, base decimal(12,2)")
    got = dict(rows(pricing.price_total(res, offers, ["start_date"], parts=("base",)),
                    "reservation_id", "tot_amount"))
    # the earlier arrival (id 2) gets the one-time discount, id 1 pays in full
    assert got == {1: D("100.00"), 2: D("75.00"), 3: D("90.00"), 4: None, 5: D("100.00"),
                   6: D("100.00")}
    expired = dict(rows(pricing.expire_offers(offers, res), "promo_code", "status"))
    assert expired == {"ONCE": "Expired", "NULLFLAG": "Available", "NODISC": "Available"}
    usage = dict(rows(queries.promo_usage(offers, res), "promo_code", "times_used"))
    assert usage == {"NODISC": 1}   # NULL flag excluded by <> 'Y'


def test_settle_two_due_on_one_car_and_null_drop(spark):
    res = spark.createDataFrame([
        (1, "Reserved", D("10.00"), "CAR1", 201, None),
        (2, "Reserved", D("10.00"), "CAR1", 202, None),
        (3, "Reserved", D("10.00"), "CAR2", None, "ONE"),
        (4, "Reserved", D("10.00"), "CAR3", 204, None),
    ], "reservation_id int, status string, tot_amount decimal(8,2), vin string, "
       "drop_location_id int, promo_code string")
    pay = spark.createDataFrame([(1, D("10.00")), (2, D("5.00")), (2, D("5.00")), (3, D("10.00")),
                                 (4, D("9.99"))], "reservation_id int, amount_paid decimal(8,2)")
    offers = spark.createDataFrame([("ONE", "Y", None, None, "Available")], OFFER_COLS)
    cars = spark.createDataFrame([("CAR1", 100, "Unavailable"), ("CAR2", 100, "Unavailable"),
                                  ("CAR3", 100, "Unavailable")],
                                 "vin string, rental_location_id int, status string")
    out = settlement.settle(res, pay, offers, cars)
    assert dict(rows(out["reservation"], "reservation_id", "status")) == {
        1: "Completed", 2: "Completed", 3: "Completed", 4: "Reserved"}
    assert rows(out["car"]) == [("CAR1", 202, "Available"), ("CAR2", None, "Available"),
                                ("CAR3", 100, "Unavailable")]
    assert rows(out["offer_details"], "status") == [("Expired",)]
    # the NULL drop location breaks the car table's NOT NULL rule and is reported
    bad = integrity.not_null_violations(out["car"], ["rental_location_id"])
    assert rows(bad, "column_name", "n_nulls") == [("rental_location_id", 1)]


def test_overdue_as_of_boundary(spark):
    res = spark.createDataFrame([
        (1, "Reserved", dt.date(2020, 1, 5), None), (2, "Reserved", dt.date(2020, 1, 4), None),
        (3, "Reserved", dt.date(2020, 1, 4), dt.date(2020, 1, 4)),
        (4, "Completed", dt.date(2020, 1, 1), None)],
        "reservation_id int, status string, end_date date, actual_end_date date")
    as_of = dt.date(2020, 1, 5)
    assert rows(queries.overdue_reservations(res, as_of), "reservation_id") == [(2,)]
    assert rows(queries.overdue_reservations(res, as_of, strict=False), "reservation_id") == [
        (1,), (2,)]
    assert queries.overdue_reservations(res).count() == 2   # today is long after 2020


def test_ties_at_maximum(spark):
    res = spark.createDataFrame([(7, D("5.00")), (3, D("5.00")), (1, D("4.00"))],
                                "reservation_id int, tot_amount decimal(8,2)")
    assert rows(queries.max_reservation(res)) == [(3, D("5.00"))]
    assert rows(queries.top_reservations(res)) == [(3, D("5.00")), (7, D("5.00"))]


def test_integrity_edge_rows(spark):
    parent = spark.createDataFrame([("L1", "C1"), ("L2", "C2")], "login_id string, card_no string")
    child = spark.createDataFrame([
        (1, "L1", "C1"), (2, "L1", None), (3, None, "C9"), (4, "L9", "C9"), (5, "L1", "C2"),
    ], "payment_id int, login_id string, saved_card_no string")
    bad = integrity.check_foreign_key(child, parent, ["login_id", "saved_card_no"],
                                      ["login_id", "card_no"])
    assert rows(bad, "payment_id") == [(4,), (5,)]
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")],
                                "k int, v string")
    assert set(tuple(r) for r in integrity.check_primary_key(dup, ["k"]).collect()) == {
        (None, 2), (1, 2)}
    assert rows(integrity.check_unique(dup, ["k"])) == [(1, 2)]
    long_email = spark.createDataFrame([("x" * 26,), ("ok@x.test",)], "email string")
    out = integrity.check_length(long_email, {"email": 25})
    assert rows(out, "column_name", "length") == [("email", 26)]


def test_scalar_functions(spark):
    assert oracle_pattern("yyyy/mm/dd") == "yyyy/MM/dd"
    assert oracle_pattern("DD-MON-YYYY HH24:MI:SS") == "dd-MMM-yyyy HH:mm:ss"
    df = spark.createDataFrame([("1990/03/20", D("129.65"), "75123", None, "Rollins")],
                               "s string, amt decimal(8,2), z string, m string, l string")
    r = df.select(parse_date("s", "yyyy/mm/dd").alias("d"),
                  F.to_date("s", "yyyy/mm/dd").alias("wrong"),
                  round_to_int("amt").alias("i"), F.col("amt").cast("int").alias("trunc"),
                  char_pad("z", 6).alias("p"), char_equal(char_pad("z", 6), "z").alias("eq"),
                  concat_null_as_empty("a ", F.col("m"), " ", F.col("l")).alias("c")).first()
    assert r.d == dt.date(1990, 3, 20) and r.wrong == dt.date(1990, 1, 20)
    assert r.i == 130 and r.trunc == 129
    assert r.p == "75123 " and r.eq
    assert r.c == "a  Rollins"
    assert parse_date(F.lit("2015-11-06")) is not None


def test_append_rows(spark, seed):
    out = append_rows(seed["car_type"], [("Compact", D("24.95"))])
    assert out.count() == 6


def test_bounded_broadcast_falls_back(spark):
    from fleetbook.plans.joins import BYTES_KEY, ROWS_KEY, literal_rows, small_side
    from fleetbook.sources.tables import rows_frame

    schema = T.StructType([T.StructField("k", T.IntegerType())])
    small = rows_frame(spark, [(i,) for i in range(10)], schema)
    big = rows_frame(spark, [(i,) for i in range(100)], schema)
    assert literal_rows(big) == 100
    files = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    assert literal_rows(files) is None

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    spark.conf.set(ROWS_KEY, "50")
    try:
        assert hinted(bounded_broadcast(small))
        assert not hinted(bounded_broadcast(big))
        assert hinted(small_side(small)) and not hinted(small_side(big))
    finally:
        spark.conf.unset(ROWS_KEY)
    spark.conf.set(BYTES_KEY, "1000")
    try:
        assert hinted(bounded_broadcast(small)) and not hinted(bounded_broadcast(big))
    finally:
        spark.conf.unset(BYTES_KEY)
    # a side derived through a shuffle is left to AQE; a column of that name changes nothing
    assert hinted(bounded_broadcast(files.withColumnRenamed("p_name", "Exchange Join")))
    assert not hinted(bounded_broadcast(files.groupBy("p_type").count()))
    # broadcasting switched off holds for everything but literal rows
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert hinted(bounded_broadcast(small))
        assert not hinted(bounded_broadcast(files)) and not hinted(small_side(files))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_declared_star_schemas_match_files(spark):
    from fleetbook.sources.tables import STAR_SCHEMAS, read_table

    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        for name in STAR_SCHEMAS:
            inferred = spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet").schema
            declared = read_table(spark, f"/root/testdata/{sf}", name).schema
            assert inferred.simpleString() == declared.simpleString(), (sf, name)


def test_cap_payment_unknown_reservation_and_exact_total(spark):
    res = spark.createDataFrame([(1, D("50.00"))], "reservation_id int, tot_amount decimal(8,2)")
    pay = spark.createDataFrame([(10, 1, D("50.00")), (11, 1, D("50.01")), (12, 99, D("70.00"))],
                                "payment_id int, reservation_id int, amount_paid decimal(8,2)")
    got = dict(rows(pricing.cap_payment(pay, res), "payment_id", "amount_paid"))
    assert got == {10: D("50.00"), 11: D("50.00"), 12: D("70.00")}
