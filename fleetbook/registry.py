"""Registered queries over the driver's test tables, each with its DuckDB
oracle. Every query reads whole tables through ``fleetbook.starmap`` and
runs the library operators on them; the oracle states the same result in
plain SQL over the pre-registered views.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook import jobs
from fleetbook import starmap as sm
from fleetbook.functions.scalars import (char_pad, concat_null_as_empty, format_date, money,
                                         parse_date, round_to_int)
from fleetbook.operators import integrity, pricing, queries, reports, settlement
from fleetbook.plans import statistics
from fleetbook.plans.joins import bounded_broadcast, distinct_side, small_side
from fleetbook.session import scratch_path
from fleetbook.sources import catalog, partitioned
from fleetbook.sources.bucketed import read_bucketed, write_bucketed
from fleetbook.sources.schemas import ForeignKey
from fleetbook.sources.tables import append_rows, read_table, rows_frame, scan_all, stream_table, table_path
from fleetbook.streaming import arrivals, first_uses, state
from fleetbook.streaming import payments as stream_payments
from fleetbook.streaming import promos as stream_promos

QueryFn = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(1996, 1, 1)
AS_OF_SQL = "DATE '1996-01-01'"
ARRIVAL = ("start_date",)
OVERDUE_SQL = (f"r.status = 'Reserved' AND r.end_date < {AS_OF_SQL} "
               "AND r.actual_end_date IS NULL")


def _sql_concat(texts, *values: str) -> str:
    """Texts around values as SQL; NULL reads as empty."""
    parts = [x for t, v in zip(texts, values) for x in (f"'{t}'", f"coalesce({v}, '')")]
    return " || ".join([*parts, f"'{texts[-1]}'"])

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def _res(spark, d, coded=False):
    return sm.reservations(_t(spark, d, "orders"), coded)


def _open(spark, d):
    """Reservations with the order's own status, and the code of an open one,
    so that the status filter reaches the reader."""
    return _res(spark, d, coded=True), sm.RESERVED


def _pay(spark, d):
    return sm.payments(_t(spark, d, "lineitem"))


def _rentals(spark, d):
    return sm.rentals(_t(spark, d, "lineitem"), _t(spark, d, "orders"))


# ---------------------------------------------------------------- scans, sinks

@register("scan_all", "SELECT * FROM region")
def scan_all_q(spark, d):
    return scan_all(spark, d, "region")


@register("append_rows", "SELECT * FROM region UNION ALL "
          "SELECT * FROM (VALUES (5, 'A'), (6, 'B')) AS t(r_regionkey, r_name)")
def append_rows_q(spark, d):
    return append_rows(_t(spark, d, "region"), [(5, "A"), (6, "B")])


# ------------------------------------------------------ projections, filters

@register("project_columns", "SELECT c.c_custkey AS k, c.c_name AS n FROM customer AS c")
def project_columns_q(spark, d):
    return queries.project_columns(_t(spark, d, "customer"), {"c_custkey": "k", "c_name": "n"},
                                   alias="c")


@register("filter_price", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 985")
def filter_price_q(spark, d):
    return queries.filter_above(_t(spark, d, "part"), "p_retailprice", 985).select(
        "p_partkey", "p_retailprice")


@register("filter_overdue", sm.with_views(
    f"SELECT r.reservation_id, r.license_no, r.end_date FROM reservations r WHERE {OVERDUE_SQL}",
    "reservations"))
def filter_overdue_q(spark, d):
    res, reserved = _open(spark, d)
    return queries.overdue_reservations(res, AS_OF, reserved=reserved).select(
        "reservation_id", "license_no", "end_date")


@register("filter_overdue_today", sm.with_views(
    "SELECT reservation_id, license_no, end_date FROM reservations WHERE actual_end_date IS NULL "
    "AND end_date <= current_date AND status = 'Reserved'", "reservations"))
def filter_overdue_today_q(spark, d):
    """By today's date, the rentals that are due today included."""
    res, reserved = _open(spark, d)
    return queries.overdue_reservations(res, reserved=reserved).select(
        "reservation_id", "license_no", "end_date")


_FLAG_SQL = ("CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN 'Y' ELSE 'N' END")


@register("filter_not_one_time",
          f"SELECT o_orderkey, is_one_time FROM (SELECT o_orderkey, {_FLAG_SQL} AS is_one_time "
          "FROM orders) AS t WHERE is_one_time <> 'Y'")
def filter_not_one_time_q(spark, d):
    pr = F.col("o_orderpriority")
    flagged = _t(spark, d, "orders").select(
        "o_orderkey",
        F.when(pr == "5-LOW", F.lit(None).cast("string"))
         .when(pr == "2-HIGH", "Y").otherwise("N").alias("is_one_time"))
    return queries.filter_not_equal(flagged, "is_one_time", "Y")


# ------------------------------------------------------------------- joins

@register("join_payments", sm.with_views(
    "SELECT reservation_id, tot_amount, amount_paid "
    "FROM payments JOIN reservations USING (reservation_id)", "reservations", "payments"))
def join_payments_q(spark, d):
    return queries.join_payments(_res(spark, d), _pay(spark, d))


@register("rented_types_over_price",
          "SELECT DISTINCT p_type, p_brand FROM part WHERE p_retailprice > 910 AND p_partkey IN "
          "(SELECT l_partkey FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey)")
def rented_types_over_price_q(spark, d):
    return queries.rented_types_over_price(
        _t(spark, d, "part"), _t(spark, d, "lineitem"), _t(spark, d, "orders"), 910,
        type_key="p_partkey", price="p_retailprice", car_type="l_partkey",
        car_vin="l_orderkey", res_vin="o_orderkey", output=("p_type", "p_brand"), one_per_car=True)


@register("left_join_insurance",
          "SELECT * FROM nation n LEFT JOIN supplier s "
          "ON n.n_nationkey = s.s_nationkey AND s.s_acctbal > 9000")
def left_join_insurance_q(spark, d):
    return queries.left_join_lookup(_t(spark, d, "nation"), _t(spark, d, "supplier"),
                                    [("n_nationkey", "s_nationkey")],
                                    right_filter=F.col("s_acctbal") > 9000)


@register("locations_with_cars",
          "SELECT n_nationkey, n_name FROM nation n WHERE EXISTS (SELECT 1 FROM supplier s "
          "WHERE s.s_nationkey = n.n_nationkey AND s.s_acctbal > 9000)")
def locations_with_cars_q(spark, d):
    return queries.exists_in(_t(spark, d, "nation"), _t(spark, d, "supplier"),
                             "n_nationkey", "s_nationkey",
                             right_filter=F.col("s_acctbal") > 9000).select("n_nationkey", "n_name")


@register("reserved_models",
          "SELECT p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem "
          "WHERE l_partkey = p_partkey AND l_quantity > 49)")
def reserved_models_q(spark, d):
    return queries.exists_in(_t(spark, d, "part"), _t(spark, d, "lineitem"),
                             "p_partkey", "l_partkey",
                             right_filter=F.col("l_quantity") > 49).select("p_name")


# Payments as they are stored: each capped at its order's total
_STORED_SQL = ("SELECT reservation_id, least(amount_paid, tot_amount) AS amount_paid "
               "FROM payments JOIN reservations USING (reservation_id)")
_FIRST_BY_AMOUNT = (f"SELECT amount_paid AS amount, min(reservation_id) AS first_id FROM ({_STORED_SQL}) AS stored "
                    "GROUP BY amount_paid")


def _stored_payments(spark, d):
    return pricing.cap_payment(_pay(spark, d), _res(spark, d)).select("reservation_id", "amount_paid")


@register("users_without_exact_payment", sm.with_views(
    "SELECT license_no, fname FROM users ANTI JOIN (SELECT license_no FROM reservations JOIN "
    f"({_FIRST_BY_AMOUNT}) AS f ON amount = tot_amount AND first_id = reservation_id) AS paid "
    "USING (license_no)", "users", "reservations", "payments"))
def users_without_exact_payment_q(spark, d):
    """Users none of whose orders is paid by one payment of its total; of
    several payments of one amount that for the smallest order counts."""
    return queries.users_without_exact_payment(
        sm.users(_t(spark, d, "customer")), _res(spark, d), _stored_payments(spark, d),
        output=("license_no", "fname"), on_many="min")


@register("exactly_paid_reservations", sm.with_views(
    f"SELECT reservation_id, license_no FROM reservations JOIN ({_FIRST_BY_AMOUNT}) AS f "
    "ON amount = tot_amount AND first_id = reservation_id", "reservations", "payments"))
def exactly_paid_reservations_q(spark, d):
    return queries.exactly_paid_reservations(
        _res(spark, d), _stored_payments(spark, d), on_many="min").select(
        "reservation_id", "license_no")


@register("not_in_with_null",
          "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ("
          "SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END FROM orders)")
def not_in_with_null_q(spark, d):
    owners = _t(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey")).alias("k"))
    return queries.not_in(_t(spark, d, "customer"), owners, "c_custkey", "k").select(
        "c_custkey", "c_name")


_DUE_SQL = ("SELECT r.* FROM reservations r JOIN (SELECT reservation_id AS paid_id, "
            "sum(amount_paid) AS paid FROM payments GROUP BY reservation_id) AS s "
            "ON s.paid_id = r.reservation_id AND s.paid >= r.tot_amount WHERE r.status = 'Reserved'")


def _due(spark, d):
    res, reserved = _open(spark, d)
    return settlement.due_reservations(res, _pay(spark, d), reserved=reserved, few_open=None)


@register("settle_due", sm.with_views(_DUE_SQL, "reservations", "payments"))
def settle_due_q(spark, d):
    return _due(spark, d).withColumn("status", sm.status_name("status"))


MONTH = ("1996-01-01", "1996-02-01")
_MONTH_SQL = f"(r.start_date >= DATE '{MONTH[0]}' AND r.start_date < DATE '{MONTH[1]}')"


def _month_orders(spark, d):
    """The orders of one month: few of all, by a range that reaches the reader."""
    day = F.col("o_orderdate")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in MONTH)
    return _t(spark, d, "orders").where((day >= lo) & (day < hi))


@register("settle_due_month", sm.with_views(f"{_DUE_SQL} AND {_MONTH_SQL}", "reservations", "payments"))
def settle_due_month_q(spark, d):
    """Due among the open orders of one month: those are few, so their keys
    prune the payments before the sum."""
    due = settlement.due_reservations(sm.reservations(_month_orders(spark, d), coded=True), _pay(spark, d),
                                      reserved=sm.RESERVED, few_open=True)
    return due.withColumn("status", sm.status_name("status"))


@register("settle_reservations_month", sm.with_views(
    "SELECT r.reservation_id, CASE WHEN d.reservation_id IS NOT NULL THEN 'Completed' ELSE r.status END AS status "
    f"FROM reservations r LEFT JOIN ({_DUE_SQL} AND {_MONTH_SQL}) AS d ON d.reservation_id = r.reservation_id",
    "reservations", "payments"))
def settle_reservations_month_q(spark, d):
    """The whole reservation table after one month's open orders are settled."""
    due = small_side(settlement.due_reservations(
        sm.reservations(_month_orders(spark, d), coded=True), _pay(spark, d), reserved=sm.RESERVED,
        few_open=True).select("reservation_id"))
    done = settlement.settle_reservations(_res(spark, d, coded=True), due=due, reserved=sm.RESERVED,
                                          completed=sm.COMPLETED)
    return done.select("reservation_id", sm.status_name("status").alias("status"))


@register("overdue_lookup", sm.with_views(
    "SELECT r.reservation_id, r.license_no, u.fname FROM reservations r "
    f"JOIN users u ON u.license_no = r.license_no WHERE {OVERDUE_SQL}", "reservations", "users"))
def overdue_lookup_q(spark, d):
    res, reserved = _open(spark, d)
    return queries.overdue_with_user(
        res, sm.users(_t(spark, d, "customer")), as_of=AS_OF, reserved=reserved,
        user_cols=("fname",), res_cols=("reservation_id", "license_no"))


_PROMO_USAGE_SQL = ("SELECT promo_code, count(reservation_id) AS times_used FROM offers "
                    "LEFT JOIN (SELECT promo_code, reservation_id FROM reservations) AS r "
                    "USING (promo_code) WHERE is_one_time <> 'Y' GROUP BY promo_code")


@register("promo_usage", sm.with_views(_PROMO_USAGE_SQL, "offers", "reservations"))
def promo_usage_q(spark, d):
    return queries.promo_usage(sm.offers(spark), _res(spark, d))


# ------------------------------------------------------- aggregates, top-k

@register("max_reservation", sm.with_views(
    "SELECT min(reservation_id) AS reservation_id, tot_amount FROM reservations "
    "WHERE tot_amount = (SELECT max(tot_amount) FROM reservations) GROUP BY tot_amount",
    "reservations"))
def max_reservation_q(spark, d):
    return queries.max_reservation(_res(spark, d))


def _orders_file(spark, d):
    return spark, table_path(d, "orders"), _t(spark, d, "orders").schema, "o_totalprice"


@register("max_reservation_from_statistics", ORACLE["max_reservation"])
def max_reservation_from_statistics_q(spark, d):
    """The maximum from the footers, the smallest of its reservations."""
    return queries.max_reservation(sm.reservations(statistics.rows_at_maximum(*_orders_file(spark, d))))


@register("top1_reservation", sm.with_views(
    "SELECT reservation_id, tot_amount FROM (SELECT reservation_id, tot_amount, "
    "rank() OVER (ORDER BY tot_amount DESC) AS rk FROM reservations) AS t WHERE rk = 1",
    "reservations"))
def top1_reservation_q(spark, d):
    return queries.top_reservations(_res(spark, d))


@register("top1_reservation_from_statistics", ORACLE["top1_reservation"])
def top1_reservation_from_statistics_q(spark, d):
    return sm.reservations(statistics.rows_at_maximum(*_orders_file(spark, d))).select(
        "reservation_id", "tot_amount")


# ----------------------------------------------------------------- reports

@register("overdue_report", sm.with_views(
    "SELECT r.reservation_id, "
    f"{_sql_concat(reports.OVERDUE_TEXT, 'u.fname', 'u.mname', 'u.lname', 'u.email', 'rtrim(r.vin)')} AS line "
    f"FROM reservations r JOIN users u ON u.license_no = r.license_no WHERE {OVERDUE_SQL}",
    "reservations", "users"))
def overdue_report_q(spark, d):
    res, reserved = _open(spark, d)
    return reports.overdue_report(res, sm.users(_t(spark, d, "customer")), as_of=AS_OF,
                                  reserved=reserved)


@register("promo_usage_report", sm.with_views(
    f"SELECT promo_code, {_sql_concat(reports.PROMO_TEXT, 'promo_code', 'times_used::VARCHAR')} AS line "
    f"FROM ({_PROMO_USAGE_SQL}) AS u",
    "offers", "reservations"))
def promo_usage_report_q(spark, d):
    return reports.promo_usage_report(sm.offers(spark), _res(spark, d))


# ---------------------------------------------------------- scalar functions

@register("concat_null_as_empty",
          "SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL "
          "ELSE c_mktsegment END, '') || ' ' || coalesce(c_name, '') AS text FROM customer")
def concat_null_as_empty_q(spark, d):
    seg = F.col("c_mktsegment")
    segment = F.when(seg == "BUILDING", F.lit(None).cast("string")).otherwise(seg)
    return _t(spark, d, "customer").select(
        "c_custkey", concat_null_as_empty(segment, " ", F.col("c_name")).alias("text"))


@register("parse_date",
          "SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y/%m/%d'), '%Y/%m/%d') "
          "AS DATE) AS order_day, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS iso_day "
          "FROM orders")
def parse_date_q(spark, d):
    """Dates written as text and read back: with a ``TO_DATE`` format, and
    as ISO text converted implicitly."""
    text = format_date("o_orderdate", "yyyy/mm/dd")
    iso = format_date("o_orderdate", "yyyy-MM-dd", dialect="spark")
    return _t(spark, d, "orders").select("o_orderkey",
                                         parse_date(text, "yyyy/mm/dd").alias("order_day"),
                                         parse_date(iso).alias("iso_day"))


@register("round_to_int",
          "SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(12,2)), 0) AS INTEGER) "
          "AS total_units FROM orders")
def round_to_int_q(spark, d):
    return _t(spark, d, "orders").select(
        "o_orderkey", round_to_int(money("o_totalprice")).alias("total_units"))


@register("char_pad",
          "SELECT n_nationkey, CASE WHEN length(n_name) < 12 THEN rpad(n_name, 12, ' ') "
          "ELSE n_name END AS n_name_padded FROM nation")
def char_pad_q(spark, d):
    return _t(spark, d, "nation").select("n_nationkey",
                                         char_pad("n_name", 12).alias("n_name_padded"))


# ------------------------------------------------------------------ pricing

@register("penalty_amount", sm.with_views(
    "SELECT reservation_id, line_no, CASE WHEN date_diff('day', end_date, actual_end_date) >= 0 "
    "THEN CAST(date_diff('day', end_date, actual_end_date) * 50 AS DECIMAL(12,2)) "
    "ELSE penalty_amount END AS penalty_amount FROM rentals", "rentals"))
def penalty_amount_q(spark, d):
    return pricing.penalty_amount(_rentals(spark, d)).select(
        "reservation_id", "line_no", "penalty_amount")


@register("rent_amount", sm.with_views(
    "SELECT r.reservation_id, r.line_no, r.vin, CAST(p.price_per_day * "
    "date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) AS rental_amount "
    "FROM rentals r LEFT JOIN prices p ON p.vin = r.vin", "rentals", "prices"))
def rent_amount_q(spark, d):
    return pricing.rent_amount(_rentals(spark, d), sm.prices(_t(spark, d, "part"))).select(
        "reservation_id", "line_no", "vin", "rental_amount")


@register("type_rent_amount", sm.with_views(
    "SELECT r.reservation_id, r.line_no, r.vin, CAST(t.price_per_day * "
    "date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) AS rental_amount "
    "FROM rentals r LEFT JOIN part ON p_partkey = r.vin LEFT JOIN type_prices t "
    "ON t.car_type = p_type", "rentals", "type_prices"))
def type_rent_amount_q(spark, d):
    """The price by two lookups: line to car type, type to daily price."""
    cars = sm.prices(_t(spark, d, "part")).select("vin", "car_type")
    return pricing.rent_amount(_rentals(spark, d), pricing.car_prices(cars, sm.type_prices(spark))).select(
        "reservation_id", "line_no", "vin", "rental_amount")


@register("insurance_amount", sm.with_views(
    "SELECT r.reservation_id, r.line_no, r.insurance_type, CAST(i.insurance_price * "
    "date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) AS insurance_amount "
    "FROM rentals r LEFT JOIN prices p ON p.vin = r.vin LEFT JOIN rates i "
    "ON i.car_type = p.car_type AND i.insurance_type = r.insurance_type",
    "rentals", "prices", "rates"))
def insurance_amount_q(spark, d):
    car_types = sm.prices(_t(spark, d, "part")).select("vin", "car_type")
    return pricing.insurance_amount(_rentals(spark, d), car_types, sm.rates(spark)).select(
        "reservation_id", "line_no", "insurance_type", "insurance_amount")


_FIRSTS_SQL = ("SELECT reservation_id FROM (SELECT r.reservation_id, row_number() OVER ("
               "PARTITION BY r.promo_code ORDER BY r.start_date NULLS LAST, r.reservation_id) AS rn "
               "FROM reservations r JOIN offers o ON o.promo_code = r.promo_code "
               "WHERE o.is_one_time = 'Y') AS t WHERE rn = 1")
_AVAIL_SQL = ("(o.status = 'Available' AND CASE WHEN o.is_one_time = 'Y' "
              "THEN f.reservation_id IS NOT NULL ELSE TRUE END)")


def _less_offer_sql(base: str) -> str:
    """``base`` less what an available offer takes off: its share, or without one its amount."""
    off = f"coalesce(({base}) * o.percentage * 0.01, o.discounted_amount)"
    return f"CAST(({base}) - if({_AVAIL_SQL}, {off}, 0) AS DECIMAL(12,2))"


@register("price_total", sm.with_views(
    f"SELECT r.reservation_id, r.promo_code, {_less_offer_sql('r.tot_amount')} AS tot_amount FROM reservations r "
    "LEFT JOIN offers o ON o.promo_code = r.promo_code "
    f"LEFT JOIN ({_FIRSTS_SQL}) AS f ON f.reservation_id = r.reservation_id",
    "reservations", "offers"))
def price_total_q(spark, d):
    return pricing.price_total(_res(spark, d), sm.offers(spark), ARRIVAL,
                               parts=("tot_amount",)).select(
        "reservation_id", "promo_code", "tot_amount")


@register("one_time_promo", sm.with_views(
    "SELECT r.reservation_id, r.promo_code, "
    f"CAST(CASE WHEN {_AVAIL_SQL} THEN 1 ELSE 0 END AS INTEGER) AS promo_available "
    "FROM reservations r JOIN offers o ON o.promo_code = r.promo_code "
    f"LEFT JOIN ({_FIRSTS_SQL}) AS f ON f.reservation_id = r.reservation_id",
    "reservations", "offers"))
def one_time_promo_q(spark, d):
    offers = sm.offers(spark)
    flagged = pricing.offer_available_flag(_res(spark, d), offers, ARRIVAL)
    known = offers.select(F.col("promo_code").alias("__known"))
    return (flagged.join(bounded_broadcast(known), F.col("promo_code") == F.col("__known"),
                         "left_semi")
            .select("reservation_id", "promo_code",
                    F.when(F.col("promo_available"), 1).otherwise(0).alias("promo_available")))


_LINE_DAYS = "date_diff('day', r.start_date, r.actual_end_date)"
_LATE_DAYS = "date_diff('day', r.end_date, r.actual_end_date)"
_LINE_BASE_SQL = (
    f"(CASE WHEN {_LATE_DAYS} >= 0 THEN CAST({_LATE_DAYS} * 50 AS DECIMAL(12,2)) "
    "ELSE r.penalty_amount END) "
    f"+ CAST(p.price_per_day * {_LINE_DAYS} AS DECIMAL(18,2)) "
    f"+ CAST(i.insurance_price * {_LINE_DAYS} AS DECIMAL(18,2))")


@register("price_reservations", sm.with_views(
    f"SELECT r.reservation_id, r.line_no, {_less_offer_sql(_LINE_BASE_SQL)} AS tot_amount "
    "FROM rentals r LEFT JOIN prices p ON p.vin = r.vin "
    "LEFT JOIN rates i ON i.car_type = p.car_type AND i.insurance_type = r.insurance_type "
    "LEFT JOIN offers o ON o.promo_code = r.promo_code "
    f"LEFT JOIN ({_FIRSTS_SQL}) AS f ON f.reservation_id = r.reservation_id",
    "rentals", "prices", "rates", "offers", "reservations"))
def price_reservations_q(spark, d):
    """Every rental line priced in dependency order: late fee, rent,
    insurance, then the total less the promotion available when its order
    arrived (one-time codes go to the first order that used them, decided
    on the orders so the line join is not computed twice)."""
    out = pricing.rent_and_insurance(pricing.penalty_amount(_rentals(spark, d)),
                                     sm.prices(_t(spark, d, "part")), sm.rates(spark))
    return pricing.price_total(out, sm.offers(spark), ARRIVAL, arrivals=_res(spark, d)).select(
        "reservation_id", "line_no", "tot_amount")


_OFFER_COLS_SQL = "o.promo_code, o.percentage, o.discounted_amount, o.is_one_time"


@register("expire_offers", sm.with_views(
    f"SELECT {_OFFER_COLS_SQL}, CASE WHEN o.is_one_time = 'Y' AND EXISTS (SELECT 1 FROM "
    "reservations r WHERE r.promo_code = o.promo_code) THEN 'Expired' ELSE o.status END AS status "
    "FROM offers o", "offers", "reservations"))
def expire_offers_q(spark, d):
    return pricing.expire_offers(sm.offers(spark), _res(spark, d))


@register("cap_payment", sm.with_views(
    "SELECT p.reservation_id, p.line_no, CASE WHEN p.amount_paid > r.tot_amount "
    "THEN r.tot_amount ELSE p.amount_paid END AS amount_paid FROM payments p "
    "LEFT JOIN reservations r ON r.reservation_id = p.reservation_id",
    "payments", "reservations"))
def cap_payment_q(spark, d):
    return pricing.cap_payment(_pay(spark, d), _res(spark, d)).select(
        "reservation_id", "line_no", "amount_paid")


# -------------------------------------------------------- SQL functions

@register("raise_rates_by_name", "SELECT car_type, insurance_type, CAST(price_per_day + price_per_day * 7.5 * 0.01 "
          f"AS DECIMAL(8,2)) AS insurance_price FROM ({sm.RENTED_PRICES_SQL}) AS t")
def raise_rates_by_name_q(spark, d):
    """The rate of every car and cover raised by calling the procedure in SQL."""
    sm.rented_prices(_t(spark, d, "part")).createOrReplaceTempView("fleetbook_car_rates")
    catalog.register_functions(spark, {"car_insurance": "fleetbook_car_rates"})
    return spark.sql("SELECT * FROM raise_rates(7.5)")


@register("price_lines_by_name", sm.with_views(
    "SELECT r.reservation_id, r.line_no, "
    f"{_less_offer_sql(_LINE_BASE_SQL)} AS tot_amount "
    "FROM rentals r LEFT JOIN prices p ON p.vin = r.vin "
    "LEFT JOIN rates i ON i.car_type = p.car_type AND i.insurance_type = r.insurance_type "
    "LEFT JOIN offers o ON o.promo_code = r.promo_code "
    f"LEFT JOIN ({_FIRSTS_SQL}) AS f ON f.reservation_id = r.reservation_id",
    "rentals", "prices", "rates", "offers", "reservations"))
def price_lines_by_name_q(spark, d):
    """Every rental line priced with the SQL functions."""
    catalog.register_functions(spark)
    terms = pricing.offer_available_flag(_rentals(spark, d), sm.offers(spark), ARRIVAL, arrivals=_res(spark, d))
    for name, df in (("lines", terms), ("prices", sm.prices(_t(spark, d, "part"))), ("rates", sm.rates(spark))):
        df.createOrReplaceTempView(f"fleetbook_{name}")
    return spark.sql("""
        SELECT l.reservation_id, l.line_no, total_after_offer(
                   late_fee(l.end_date, l.actual_end_date, l.penalty_amount)
                   + rental_price(p.price_per_day, l.start_date, l.actual_end_date)
                   + rental_price(r.insurance_price, l.start_date, l.actual_end_date),
                   l.percentage, l.discounted_amount, l.promo_available) AS tot_amount
        FROM fleetbook_lines l LEFT JOIN fleetbook_prices p ON p.vin = l.vin
             LEFT JOIN fleetbook_rates r ON r.car_type = p.car_type AND r.insurance_type = l.insurance_type""")


# ------------------------------------------------------- co-located joins

def _bucketed(spark, name: str, df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the catalogue, bucketed by reservation."""
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"fleetbook_{name}_{uuid.uuid4().hex[:12]}"
    return read_bucketed(spark, table, write_bucketed(df, table, "reservation_id", buckets))


@register("join_payments_bucketed", ORACLE["join_payments"])
def join_payments_bucketed_q(spark, d):
    return queries.join_payments(_bucketed(spark, "totals", _res(spark, d).select("reservation_id", "tot_amount")),
                                 _bucketed(spark, "payments", _pay(spark, d).select("reservation_id", "amount_paid")))


@register("cap_payment_bucketed", ORACLE["cap_payment"])
def cap_payment_bucketed_q(spark, d):
    totals = _bucketed(spark, "totals", _res(spark, d).select("reservation_id", "tot_amount"))
    return pricing.cap_payment(_bucketed(spark, "payments", _pay(spark, d)), totals).select(
        "reservation_id", "line_no", "amount_paid")


@register("settle_due_bucketed", ORACLE["settle_due"])
def settle_due_bucketed_q(spark, d):
    """The sum and the join read the buckets: no exchange of either table."""
    res = _bucketed(spark, "reservations", _res(spark, d, coded=True))
    pay = _bucketed(spark, "payments", _pay(spark, d).select("reservation_id", "amount_paid"))
    return settlement.due_reservations(res, pay, reserved=sm.RESERVED).withColumn("status", sm.status_name("status"))


# --------------------------------------------------------------- settlement

@register("settle_reservations", sm.with_views(
    "SELECT r.reservation_id, CASE WHEN d.reservation_id IS NOT NULL THEN 'Completed' "
    f"ELSE r.status END AS status FROM reservations r LEFT JOIN ({_DUE_SQL}) AS d "
    "ON d.reservation_id = r.reservation_id", "reservations", "payments"))
def settle_reservations_q(spark, d):
    res, reserved = _open(spark, d)
    done = settlement.settle_reservations(res, _pay(spark, d), reserved=reserved,
                                          completed=sm.COMPLETED, few_open=None)
    return done.select("reservation_id", sm.status_name("status").alias("status"))


@register("settle_offers", sm.with_views(
    f"SELECT {_OFFER_COLS_SQL}, CASE WHEN o.is_one_time = 'Y' AND EXISTS (SELECT 1 FROM "
    f"({_DUE_SQL}) AS d WHERE d.promo_code = o.promo_code) THEN 'Expired' ELSE o.status END "
    "AS status FROM offers o", "offers", "reservations", "payments"))
def settle_offers_q(spark, d):
    return settlement.settle_offers(sm.offers(spark), _due(spark, d))


@register("settle_cars", sm.with_views(
    f"SELECT c.vin, CASE WHEN w.vin IS NOT NULL THEN w.drop_location_id "
    "ELSE c.rental_location_id END AS rental_location_id, "
    "CASE WHEN w.vin IS NOT NULL THEN 'Available' ELSE c.status END AS status "
    "FROM cars c LEFT JOIN (SELECT vin, drop_location_id FROM (SELECT l.vin, l.drop_location_id, "
    "row_number() OVER (PARTITION BY l.vin ORDER BY l.reservation_id DESC, "
    "l.drop_location_id DESC) AS rn FROM rentals l WHERE l.reservation_id IN ("
    f"SELECT reservation_id FROM ({_DUE_SQL}) AS d)) AS x WHERE rn = 1) AS w ON w.vin = c.vin",
    "cars", "rentals", "reservations", "payments"))
def settle_cars_q(spark, d):
    # the due keys are a subset of the orders: written once and, when small,
    # broadcast into the line scan, so the lines are not shuffled for them
    due = small_side(_due(spark, d).select("reservation_id"))
    due_rentals = sm.rental_lines(_t(spark, d, "lineitem")).join(due, "reservation_id",
                                                                  "left_semi")
    return settlement.settle_cars(sm.cars(_t(spark, d, "part")), due_rentals).select(
        "vin", "rental_location_id", "status")


@register("raise_rates", sm.with_views(
    "SELECT vin, CAST(price_per_day + price_per_day * 7.5 * 0.01 AS DECIMAL(12,2)) "
    "AS price_per_day FROM prices", "prices"))
def raise_rates_q(spark, d):
    return settlement.raise_rates(sm.prices(_t(spark, d, "part")), Decimal("7.5"),
                                  price="price_per_day").select("vin", "price_per_day")


# --------------------------------------------------- partitions by month

_LINE_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def _by_month(spark, df, date):
    path = scratch_path(spark, "by_month")
    partitioned.write_by_month(df, path, date, f"{date}_month")
    return path


@register("filter_overdue_by_month", ORACLE["filter_overdue"])
def filter_overdue_by_month_q(spark, d):
    """Overdue among the months up to the date: other months are not read."""
    res, reserved = _open(spark, d)
    table = spark.read.parquet(_by_month(spark, res, "end_date"))
    return queries.overdue_reservations(
        partitioned.between_months(table, "end_date_month", hi=AS_OF), AS_OF, reserved=reserved).select(
        "reservation_id", "license_no", "end_date")


@register("payments_of_due_months", sm.with_views(
    "SELECT p.reservation_id, p.line_no, p.amount_paid FROM payments p JOIN reservations r "
    f"ON r.reservation_id = p.reservation_id WHERE r.status = 'Reserved' AND {_MONTH_SQL}",
    "reservations", "payments"))
def payments_of_due_months_q(spark, d):
    """Payments kept by the month of their reservation, looked up for the open
    reservations of one month: the months come from the other side of the
    join at run time, and other folders are not read."""
    months = _res(spark, d).select("reservation_id", "start_date")
    pay = spark.read.parquet(_by_month(spark, _pay(spark, d).join(months, "reservation_id"), "start_date"))
    path = scratch_path(spark, "open")
    sm.reservations(_month_orders(spark, d)).select("reservation_id", "status", "start_date").write.parquet(path)
    heads = spark.read.parquet(path).where(F.col("status") == "Reserved").select(
        "reservation_id", partitioned.month_of("start_date").alias("start_date_month"))
    return queries.look_up_in_months(pay, heads, "start_date_month", "reservation_id").select(
        "reservation_id", "line_no", "amount_paid")


@register("settle_month_partitions", ORACLE["settle_reservations_month"])
def settle_month_partitions_q(spark, d):
    """The reservation table kept by month and settled in place for one month:
    the other months' files stay."""
    path = _by_month(spark, _res(spark, d), "start_date")
    lo = dt.date.fromisoformat(MONTH[0])
    jobs.settle_partitions(spark, path, "start_date_month", _pay(spark, d),
                           lambda t: partitioned.between_months(t, "start_date_month", lo, lo))
    return spark.read.parquet(path).select("reservation_id", "status")


@register("settle_cars_partitions", ORACLE["settle_cars"])
def settle_cars_partitions_q(spark, d):
    """The cars kept by brand, and moved in place: brands without a due car stay."""
    due = small_side(_due(spark, d).select("reservation_id"))
    due_rentals = sm.rental_lines(_t(spark, d, "lineitem")).join(due, "reservation_id", "left_semi")
    moved = small_side(due_rentals.select(F.col("vin").alias("__due_vin")).distinct())
    part = _t(spark, d, "part")
    path = scratch_path(spark, "cars")
    brands = part.select(F.col("p_partkey").alias("vin"), F.col("p_brand").alias("brand"))
    sm.cars(part).join(brands, "vin").write.partitionBy("brand").parquet(path)
    partitioned.update_partitions(
        spark, path, "brand", lambda t: t.join(moved, F.col("vin") == F.col("__due_vin"), "left_semi"),
        lambda t: settlement.settle_cars(t, due_rentals))
    return spark.read.parquet(path).select("vin", "rental_location_id", "status")


@register("cascade_delete_month",
          f"SELECT {', '.join(_LINE_COLS)} FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o "
          "JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderkey = l.l_orderkey "
          f"AND c.c_mktsegment = 'BUILDING' AND o.o_orderdate >= DATE '{MONTH[0]}' AND o.o_orderdate < DATE '{MONTH[1]}')")
def cascade_delete_month_q(spark, d):
    """One month's orders of some customers deleted in place, with their
    lines: both tables are kept by the order's month, and no other month is
    written."""
    orders = _t(spark, d, "orders").select(F.col("o_orderkey").alias("reservation_id"), "o_custkey",
                                           F.to_date("o_orderdate").alias("start_date"))
    lines = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("reservation_id"), *_LINE_COLS)
    parent = _by_month(spark, orders, "start_date")
    child = _by_month(spark, lines.join(orders.select("reservation_id", "start_date"), "reservation_id"), "start_date")
    building = _t(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    lo = dt.date.fromisoformat(MONTH[0])
    jobs.cascade_delete_partitions(
        spark, parent, child, "start_date_month",
        lambda t: partitioned.between_months(t, "start_date_month", lo, lo).join(
            building, F.col("o_custkey") == F.col("c_custkey"), "left_semi"))
    return spark.read.parquet(child).select(*_LINE_COLS)


@register("append_load_twice", ORACLE["append_rows"])
def append_load_twice_q(spark, d):
    """Rows loaded, and the load repeated as after a failure: they are there once."""
    region = _t(spark, d, "region")
    path = scratch_path(spark, "loads")
    rows = rows_frame(spark, [(5, "A"), (6, "B")], region.schema)
    for df, load in ((region, "first"), (rows, "second"), (rows, "second"), (region, "first")):
        partitioned.append_load(df, path, load)
    return partitioned.read_loads(spark, path, region.schema)


# ---------------------------------------------------------------- integrity

@register("check_primary_key",
          "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
          "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def check_primary_key_q(spark, d):
    return integrity.check_primary_key(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_unique",
          "SELECT p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL "
          "GROUP BY p_name HAVING count(*) > 1")
def check_unique_q(spark, d):
    return integrity.check_unique(_t(spark, d, "part"), ["p_name"])


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority")


@register("check_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS n_nulls FROM orders" for c in _ORDER_COLS))
def check_not_null_q(spark, d):
    return integrity.check_not_null(_t(spark, d, "orders"), list(_ORDER_COLS))


@register("check_foreign_key",
          "SELECT l_orderkey, l_linenumber FROM lineitem l WHERE l_orderkey IS NOT NULL AND "
          "NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey "
          "AND o.o_orderstatus <> 'P')")
def check_foreign_key_q(spark, d):
    parents = _t(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    return integrity.check_foreign_key(_t(spark, d, "lineitem"), parents, ["l_orderkey"],
                                       ["o_orderkey"]).select("l_orderkey", "l_linenumber")


@register("check_foreign_key_composite",
          "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey_ref FROM (SELECT l_orderkey, "
          "l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_suppkey END "
          "AS l_suppkey_ref FROM lineitem) AS c WHERE c.l_partkey IS NOT NULL AND "
          "c.l_suppkey_ref IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem p WHERE "
          "p.l_returnflag = 'A' AND p.l_partkey = c.l_partkey AND p.l_suppkey = c.l_suppkey_ref)")
def check_foreign_key_composite_q(spark, d):
    li = _t(spark, d, "lineitem")
    child = li.select("l_orderkey", "l_linenumber", "l_partkey",
                      F.when(F.col("l_returnflag") == "A", F.lit(None))
                       .otherwise(F.col("l_suppkey")).alias("l_suppkey_ref"))
    parent = distinct_side(li.where(F.col("l_returnflag") == "A").select("l_partkey", "l_suppkey"))
    return integrity.check_foreign_key(child, parent, ["l_partkey", "l_suppkey_ref"],
                                       ["l_partkey", "l_suppkey"])


@register("check_length",
          "SELECT p_partkey, 'p_name' AS column_name, p_name AS value, "
          "CAST(length(p_name) AS INTEGER) AS length FROM part WHERE length(p_name) > 10 "
          "UNION ALL SELECT p_partkey, 'p_type', p_type, CAST(length(p_type) AS INTEGER) "
          "FROM part WHERE length(p_type) > 7")
def check_length_q(spark, d):
    return integrity.check_length(_t(spark, d, "part"), {"p_name": 10, "p_type": 7},
                                  keep=["p_partkey"])


@register("cascade_delete",
          f"SELECT {', '.join(_LINE_COLS)} FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o "
          "JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderkey = l.l_orderkey "
          "AND c.c_mktsegment = 'BUILDING')")
def cascade_delete_q(spark, d):
    customer, orders, lineitem = (_t(spark, d, n) for n in ("customer", "orders", "lineitem"))
    fks = [ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
           ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",))]
    doomed = customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    kept = integrity.cascade_delete({"customer": customer, "orders": orders, "lineitem": lineitem},
                                    {"customer": doomed}, fks, cut_lineage=True)
    return kept["lineitem"].select(*_LINE_COLS)


# ---------------------------------------------------------------- streaming

@register("stream_cap_payments",
          "SELECT e.event_id, c.c_name, CASE WHEN CAST(e.value AS DECIMAL(12,2)) > "
          "CAST(c.c_acctbal AS DECIMAL(12,2)) THEN CAST(c.c_acctbal AS DECIMAL(12,2)) "
          "ELSE CAST(e.value AS DECIMAL(12,2)) END AS amount_paid "
          "FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id")
def stream_cap_payments_q(spark, d):
    """Events replayed as payments by user, capped at the user's balance."""
    base = scratch_path(spark, "stream_cap_payments")
    pay = stream_table(spark, d, "events").select(
        "event_id", F.col("user_id").alias("reservation_id"), money("value").alias("amount_paid"))
    totals = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("reservation_id"), money("c_acctbal").alias("tot_amount"),
        "c_name")
    writer = stream_payments.CappedPaymentWriter(totals, f"{base}/out", carry=("c_name",))
    stream_payments.run_foreach_batch(pay, writer, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "c_name", "amount_paid")


@register("stream_price_rentals", sm.with_views(
    "SELECT r.reservation_id, r.line_no, CASE WHEN date_diff('day', end_date, actual_end_date) >= 0 "
    "THEN CAST(date_diff('day', end_date, actual_end_date) * 50 AS DECIMAL(12,2)) "
    "ELSE penalty_amount END AS penalty_amount, CAST(p.price_per_day * "
    "date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) AS rental_amount, "
    "CAST(i.insurance_price * date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) "
    "AS insurance_amount FROM rentals r LEFT JOIN prices p ON p.vin = r.vin LEFT JOIN rates i "
    "ON i.car_type = p.car_type AND i.insurance_type = r.insurance_type",
    "rentals", "prices", "rates"))
def stream_price_rentals_q(spark, d):
    """Rental lines priced as they arrive: late fee, rent, insurance."""
    base = scratch_path(spark, "stream_price_rentals")
    _rentals(spark, d).write.parquet(f"{base}/rentals.parquet")
    lines = stream_table(spark, base, "rentals")
    writer = stream_payments.PricedRentalWriter(sm.prices(_t(spark, d, "part")), sm.rates(spark), f"{base}/out")
    stream_payments.run_foreach_batch(lines, writer, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        "reservation_id", "line_no", "penalty_amount", "rental_amount", "insurance_amount")


STREAM_SLICES = 4


@register("stream_one_time_promo",
          "SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type "
          "ORDER BY ts NULLS LAST, event_id) = 1 THEN 1 ELSE 0 END AS promo_available FROM events")
def stream_one_time_promo_q(spark, d):
    """Events replayed as reservations using code ``event_type``, arriving in
    four time-ordered micro-batches; each code is a one-time offer."""
    base = scratch_path(spark, "stream_one_time_promo")
    events = _t(spark, d, "events")
    src, out, state, ckpt = (f"{base}/{x}" for x in ("source", "out", "state", "checkpoint"))
    handler = stream_promos.OneTimeOfferUse(out, state, ("ts",), key="event_id",
                                            code="event_type")

    def run(_):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1000).parquet(src)
        stream_promos.run_batches(stream, handler, ckpt)

    stream_promos.replay_in_time_slices(events, "ts", STREAM_SLICES, src, run)
    return (spark.read.parquet(out).select("event_id", "event_type", "promo_available"))


WAIT_DAYS, RECORDED_AFTER = 400, 45
LISTED_FROM, LISTED_DAYS = "1995-01-01", 2400


@register("stream_cap_on_arrival",
          "SELECT l_orderkey AS reservation_id, l_linenumber AS line_no, CASE WHEN o_totalprice < l_extendedprice "
          "THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS amount_paid "
          "FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND "
          f"abs(date_diff('day', o_orderdate, l_shipdate) - {RECORDED_AFTER}) <= {WAIT_DAYS}")
def stream_cap_on_arrival_q(spark, d):
    """Lines paid on their ship date, orders recorded 45 days after their
    date, both arriving: a payment is capped when its order comes within 400
    days on either side, whichever is first, and kept as it is otherwise."""
    base = scratch_path(spark, "stream_cap_on_arrival")
    pay = _t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("reservation_id"), F.col("l_linenumber").alias("line_no"),
        money("l_extendedprice").alias("amount_paid"), F.col("l_shipdate").cast("timestamp").alias("paid_at"))
    made = F.col("o_orderdate").cast("timestamp") + F.expr(f"INTERVAL {RECORDED_AFTER} DAYS")
    res = _t(spark, d, "orders").select(F.col("o_orderkey").alias("reservation_id"),
                                        money("o_totalprice").alias("tot_amount"), made.alias("made_at"))
    for name, table, time, row in (("pay", pay, "paid_at", {}), ("res", res, "made_at", {"reservation_id": -1})):
        state.write_time_slices(table, time, STREAM_SLICES, f"{base}/{name}.parquet", "20 YEARS", row)
    how = {"wait": f"{WAIT_DAYS} DAYS", "delay": "800 DAYS", "salt_by": "line_no"}
    cap = partial(arrivals.capped_on_arrival, pay_time="paid_at", res_time="made_at", **how)
    writer = arrivals.ArrivalWriter(cap, f"{base}/out", f"{base}/state", key="reservation_id",
                                    left_time="paid_at", right_time="made_at", **how)
    stream_payments.run_foreach_batch(
        arrivals.both_sides(stream_table(spark, base, "pay"), stream_table(spark, base, "res")), writer, f"{base}/checkpoint")
    handed_on = spark.read.schema(pay.schema).parquet(f"{base}/out").select(*pay.columns)
    rest = arrivals.missing_payments(pay, handed_on, res, ["reservation_id", "line_no"])
    return handed_on.unionByName(rest).select("reservation_id", "line_no", "amount_paid")


@register("stream_first_uses", ORACLE["stream_one_time_promo"])
def stream_first_uses_q(spark, d):
    """The one-time codes of ``stream_one_time_promo``, used up in keyed state."""
    base = scratch_path(spark, "stream_first_uses")
    events = _t(spark, d, "events")
    kept = events.select("event_id", "event_type", "ts")

    def run(_):
        stream = spark.readStream.schema(kept.schema).option("maxFilesPerTrigger", 1000).parquet(f"{base}/source")
        uses = first_uses.first_uses(stream, key="event_id", code="event_type", order_by=["ts"])
        state.finish(state.start_with_state(
            uses.writeStream.format("parquet").option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True), spark))

    stream_promos.replay_in_time_slices(kept, "ts", STREAM_SLICES, f"{base}/source", run)
    return spark.read.parquet(f"{base}/out").select("event_id", "event_type", "promo_available")


@register("stream_price_on_arrival", sm.with_views(
    "SELECT r.reservation_id, r.line_no, CASE WHEN date_diff('day', end_date, actual_end_date) >= 0 "
    "THEN CAST(date_diff('day', end_date, actual_end_date) * 50 AS DECIMAL(12,2)) "
    "ELSE penalty_amount END AS penalty_amount, CAST(p.price_per_day * "
    "date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) AS rental_amount, "
    "CAST(i.insurance_price * date_diff('day', r.start_date, r.actual_end_date) AS DECIMAL(18,2)) "
    "AS insurance_amount FROM rentals r LEFT JOIN prices p ON p.vin = r.vin "
    f"AND abs(date_diff('day', DATE '{LISTED_FROM}', r.start_date) - p.vin % {LISTED_DAYS}) <= {WAIT_DAYS} "
    "LEFT JOIN rates i ON i.car_type = p.car_type AND i.insurance_type = r.insurance_type",
    "rentals", "prices", "rates"))
def stream_price_on_arrival_q(spark, d):
    """Rental lines booked on their order's date and cars listed on a day
    fixed by their id, both arriving: a line is priced when its car comes
    within 400 days on either side, and has no rent otherwise."""
    base = scratch_path(spark, "stream_price_on_arrival")
    _rentals(spark, d).withColumn("booked_at", F.col("start_date").cast("timestamp")).write.parquet(f"{base}/lines")
    lines = spark.read.parquet(f"{base}/lines")
    listed = F.date_add(F.lit(LISTED_FROM).cast("date"), (F.col("vin") % LISTED_DAYS).cast("int")).cast("timestamp")
    cars = sm.prices(_t(spark, d, "part")).withColumn("listed_at", listed)
    state.write_time_slices(lines, "booked_at", STREAM_SLICES, f"{base}/rentals.parquet", "20 YEARS")
    state.write_time_slices(cars, "listed_at", STREAM_SLICES, f"{base}/cars.parquet", "20 YEARS", {"vin": -1})
    how = {"wait": f"{WAIT_DAYS} DAYS", "delay": "800 DAYS", "salt_by": "reservation_id"}
    price = partial(arrivals.priced_on_arrival, rates=sm.rates(spark), rent_time="booked_at", car_time="listed_at", **how)
    writer = arrivals.ArrivalWriter(price, f"{base}/out", f"{base}/state", key="vin",
                                    left_time="booked_at", right_time="listed_at", **how)
    stream_payments.run_foreach_batch(
        arrivals.both_sides(stream_table(spark, base, "rentals"), stream_table(spark, base, "cars")), writer, f"{base}/checkpoint")
    priced = price(lines, cars).schema
    handed_on = spark.read.schema(priced).parquet(f"{base}/out").select(*priced.names)
    rest = arrivals.missing_rentals(lines, handed_on, cars, sm.rates(spark), ["reservation_id", "line_no"])
    return handed_on.unionByName(rest).select(
        "reservation_id", "line_no", "penalty_amount", "rental_amount", "insurance_amount")
