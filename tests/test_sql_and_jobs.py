"""The SQL catalogue agrees with the DataFrame operators; the maintenance
jobs read and write whole table folders."""

import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from fleetbook import jobs
from fleetbook.operators import queries
from fleetbook.sources.catalog import SQL_QUERIES, register_frames, register_tables, run_sql
from fleetbook.sources.schemas import SCHEMAS
from fleetbook.sources.tables import table_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def test_sql_matches_operators(spark, seed):
    register_frames(seed)
    expect = {
        "users_without_exact_payment": queries.users_without_exact_payment(
            seed["car_user"], seed["reservation"], seed["payment"]),
        "join_payments": queries.join_payments(seed["reservation"], seed["payment"]),
        "locations_with_cars": queries.exists_in(seed["rental_location"], seed["car"],
                                                 "rental_location_id",
                                                 "rental_location_id").select("phone"),
        "reserved_models": queries.exists_in(seed["car"], seed["reservation"], "vin",
                                             "vin").select("model"),
        "rented_types_over_price": queries.rented_types_over_price(
            seed["car_type"], seed["car"], seed["reservation"], 85),
        "max_reservation": queries.max_reservation(seed["reservation"]),
        "left_join_insurance": queries.left_join_lookup(
            seed["car_insurance"], seed["insurance"], [("insurance_type", "insurance_type")]),
        "promo_usage": queries.promo_usage(seed["offer_details"], seed["reservation"]),
    }
    assert set(expect) == set(SQL_QUERIES)
    for name, df in expect.items():
        assert rows(run_sql(spark, name)) == rows(df), name


def _write_seed(seed, base):
    for name, df in seed.items():
        df.write.mode("overwrite").parquet(table_path(base, name))


def test_jobs_round_trip(spark, seed):
    src = tempfile.mkdtemp(prefix="fb-src-", dir="/tmp")
    dst = tempfile.mkdtemp(prefix="fb-dst-", dir="/tmp")
    _write_seed(seed, src)
    assert set(register_tables(spark, src)) == set(SCHEMAS)

    jobs.settle_job(spark, src, dst)
    res = spark.read.parquet(table_path(dst, "reservation"))
    assert rows(res.where("status = 'Reserved'")) == []
    car = spark.read.parquet(table_path(dst, "car")).where("vin = 'N892993994858292'")
    assert rows(car.select("rental_location_id", "status")) == [(104, "Available")]

    jobs.raise_rates_job(spark, src, dst, 10)
    rates = spark.read.parquet(table_path(dst, "car_insurance"))
    assert rows(rates.where("insurance_price = 54.99").select("car_type")) == [("Premium",)]

    jobs.integrity_job(spark, src, dst)
    assert spark.read.parquet(table_path(dst, "integrity_report")).count() == 0

    doomed = seed["car_type"].where("car_type = 'SUV'").select("car_type")
    jobs.cascade_delete_job(spark, src, dst, {"car_type": doomed})
    left = spark.read.parquet(table_path(dst, "reservation"))
    assert sorted(r[0] for r in left.select("reservation_id").collect()) == [1, 2, 3, 5]


def test_integrity_report_finds_each_rule(spark, seed):
    t = dict(seed)
    t["car_type"] = t["car_type"].unionByName(
        spark.createDataFrame([("SUV", D("1.00"))], SCHEMAS["car_type"])).unionByName(
        spark.createDataFrame([("Van", None)], "car_type string, price_per_day decimal(8,2)"))
    t["car_user"] = t["car_user"].withColumn(
        "email", F.when(F.col("license_no") == "G30921561", F.lit("x" * 26))
        .otherwise(F.col("email")))
    t["payment"] = t["payment"].withColumn(
        "reservation_id", F.when(F.col("payment_id") == 1002, F.lit(99))
        .otherwise(F.col("reservation_id")))
    t["car"] = t["car"].withColumn(
        "reg_no", F.when(F.col("vin") == "BMW", F.lit(None)).otherwise(F.lit("SAME")))
    rep = jobs.integrity_report(t)
    found = {(r.rule, r.table_name) for r in rep.collect()}
    assert {("primary_key", "car_type"), ("length", "car_user"), ("foreign_key", "payment"),
            ("unique", "car"), ("not_null", "car_type")} <= found
    details = {r.rule: r.detail for r in rep.collect() if r.rule in ("length", "not_null")}
    assert '"column_name":"email"' in details["length"] and '"length":26' in details["length"]
    assert details["not_null"] == '{"column_name":"price_per_day","n_nulls":1}'


def test_report_masks_card_numbers(spark, seed):
    t = dict(seed)
    cards = t["card_details"]
    t["card_details"] = cards.unionByName(cards)
    found = [r.detail for r in jobs.integrity_report(t).collect() if r.table_name == "card_details"]
    numbers = [r.card_no.strip() for r in cards.collect()]
    assert found and not any(n in d for n in numbers for d in found)
    assert all("*" in d for d in found)


def test_jobs_leave_no_scratch(spark, seed):
    from fleetbook.session import ensure_checkpoint_dir
    from fleetbook.sources.tables import path_exists
    import os

    src, dst = (tempfile.mkdtemp(prefix=f"fb-{x}-", dir="/tmp") for x in ("src", "dst"))
    _write_seed(seed, src)
    root = os.path.join(ensure_checkpoint_dir(spark), "fleetbook")
    before = set(os.listdir(root)) if path_exists(spark, root) else set()
    jobs.settle_job(spark, src, dst)
    jobs.cascade_delete_job(spark, src, dst, {"car_type": seed["car_type"].where("car_type = 'SUV'").select("car_type")})
    assert set(os.listdir(root)) <= before


def test_append_and_report_writers(spark, seed):
    from fleetbook.operators.reports import promo_usage_report, write_report
    from fleetbook.session import scale_settings
    from fleetbook.sources.tables import append_rows, write_table

    base = tempfile.mkdtemp(prefix="fb-w-", dir="/tmp")
    path = table_path(base, "car_type")
    write_table(seed["car_type"], path)
    write_table(append_rows(seed["car_type"].limit(0), [("Compact", D("24.95"))]), path)
    assert spark.read.parquet(path).count() == 6
    write_report(promo_usage_report(seed["offer_details"], seed["reservation"]), f"{base}/report")
    lines = sorted(r.value for r in spark.read.text(f"{base}/report").collect())
    assert lines[0] == "Promo Code CHRISTMAS10 has been used 0 times."
    conf = scale_settings(100 << 40, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 819200


def test_cli_reports_and_jobs(spark, seed):
    from fleetbook.cli import main

    src = tempfile.mkdtemp(prefix="fb-cli-src-", dir="/tmp")
    dst = tempfile.mkdtemp(prefix="fb-cli-dst-", dir="/tmp")
    _write_seed(seed, src)
    main(["overdue-report", "--src", src, "--dst", dst, "--as-of", "2016-01-01"], spark)
    lines = [r.value for r in spark.read.text(f"{dst}/overdue_report").collect()]
    assert lines == ["User Courtney  Rollins  whose email id is courtney.r@hotmail.com has not "
                     "returned the car with VIN N892993994858292."]
    main(["promo-report", "--src", src, "--dst", dst], spark)
    assert spark.read.text(f"{dst}/promo_usage_report").count() == 3
    main(["cascade-delete", "--src", src, "--dst", dst, "--table", "car_user",
          "--where", "license_no = 'C11609103'"], spark)
    assert spark.read.parquet(table_path(dst, "reservation")).count() == 2
    main(["raise-rates", "--src", src, "--dst", dst, "--percent", "10"], spark)
    assert spark.read.parquet(table_path(dst, "car_insurance")).count() == 10


def test_equal_length_violations_are_a_row_each(spark, seed):
    t = dict(seed)
    users = t["car_user"].withColumn("email", F.when(F.col("license_no") == "G30921561", F.lit("x" * 26)).otherwise(F.col("email")))
    t["car_user"] = users.unionByName(users)
    found = [r.detail for r in jobs.integrity_report(t).collect() if r.rule == "length"]
    assert len(found) == 2 and len(set(found)) == 1
