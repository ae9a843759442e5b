"""Role adapters: the driver's star-schema tables seen as rental tables.

The operators are written against rental-table column names. These views
rename and derive columns of ``customer``, ``orders``, ``lineitem`` and
``part`` into those roles, so the same operator code runs on the seed
tables and on the test data at any scale. Every view is a projection over
one scan (or one join), so Catalyst prunes the columns a query does not use
and pushes filters through the renames into the parquet scan.

Role map:

* user        = customer (license_no = c_custkey)
* reservation = order (status 'O' Reserved, 'F' Completed, 'P' Pending;
                promo code = o_orderpriority; total = o_totalprice)
* payment     = lineitem (amount = l_extendedprice, against l_orderkey)
* rental line = lineitem ⋈ orders (car = l_partkey, insurance type =
                l_returnflag, returned on l_shipdate, drop location = l_suppkey)
* car / price = part (type = p_type, daily price = p_retailprice)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.functions.scalars import money
from fleetbook.sources.tables import rows_frame

AMOUNT = T.DecimalType(12, 2)
RESERVED, COMPLETED = "O", "F"  # order statuses


def users(customer: DataFrame) -> DataFrame:
    segment = F.col("c_mktsegment")
    return customer.select(
        F.col("c_custkey").alias("license_no"),
        F.col("c_name").alias("fname"),
        F.when(segment == "BUILDING", F.lit(None).cast("string"))
         .otherwise(F.substring(segment, 1, 1)).alias("mname"),
        segment.alias("lname"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
    )


def status_name(code) -> Column:
    """The reservation status that an order status stands for."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code == RESERVED, "Reserved").when(code == COMPLETED, "Completed").otherwise("Pending")


def reservations(orders: DataFrame, coded: bool = False) -> DataFrame:
    """``coded`` keeps the order status itself (``RESERVED``, ``COMPLETED``),
    so that a filter on the status reaches the parquet reader."""
    status = F.col("o_orderstatus")
    day = F.to_date("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("reservation_id"),
        F.col("o_custkey").alias("license_no"),
        (status if coded else status_name(status)).alias("status"),
        day.alias("start_date"),
        day.alias("end_date"),
        F.when(status == "F", day).alias("actual_end_date"),
        F.col("o_orderpriority").alias("promo_code"),
        money("o_totalprice").alias("tot_amount"),
        F.col("o_orderkey").cast("string").alias("vin"),
    )


def payments(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("reservation_id"),
        F.col("l_linenumber").alias("line_no"),
        money("l_extendedprice").alias("amount_paid"),
    )


def rental_lines(lineitem: DataFrame) -> DataFrame:
    """The lines alone, without the order's dates."""
    return lineitem.select(
        F.col("l_orderkey").alias("reservation_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("vin"),
        F.col("l_returnflag").alias("insurance_type"),
        F.to_date("l_shipdate").alias("actual_end_date"),
        F.col("l_suppkey").alias("drop_location_id"),
        F.lit(None).cast(AMOUNT).alias("penalty_amount"),
    )


def rentals(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per line: the car (part) rented under an order, with the
    order's dates."""
    lines = rental_lines(lineitem)
    heads = orders.select(
        F.col("o_orderkey").alias("reservation_id"),
        F.to_date("o_orderdate").alias("start_date"),
        F.to_date("o_orderdate").alias("end_date"),
        F.col("o_orderpriority").alias("promo_code"),
    )
    return lines.join(heads, "reservation_id", "inner")


def prices(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("vin"),
        F.col("p_type").alias("car_type"),
        money("p_retailprice").alias("price_per_day"),
    )


def rented_prices(part: DataFrame) -> DataFrame:
    """A rate per car (as its type) and brand (as its cover)."""
    return part.select(F.col("p_name").alias("car_type"), F.col("p_brand").alias("insurance_type"),
                       money("p_retailprice", 8).alias("insurance_price"))


def cars(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("vin"),
        F.col("p_size").cast("bigint").alias("rental_location_id"),
        F.lit("Unavailable").alias("status"),
    )


# Offers keyed by order priority ('5-LOW' has none on purpose).
OFFER_ROWS = [
    ("1-URGENT", Decimal("10.00"), None, "N", "Available"),
    ("2-HIGH", None, Decimal("25.00"), "Y", "Available"),
    ("3-MEDIUM", None, Decimal("5.00"), "Y", "Expired"),
    ("4-NOT SPECIFIED", Decimal("15.00"), None, "N", "Expired"),
]
OFFER_SCHEMA = T.StructType([
    T.StructField("promo_code", T.StringType(), False),
    T.StructField("percentage", T.DecimalType(5, 2)),
    T.StructField("discounted_amount", T.DecimalType(8, 2)),
    T.StructField("is_one_time", T.StringType()),
    T.StructField("status", T.StringType(), False),
])

# Insurance rates keyed by (part type, return flag).
RATE_ROWS = [
    ("ECONOMY", "A", Decimal("7.25")), ("ECONOMY", "N", Decimal("14.50")),
    ("STANDARD", "A", Decimal("8.75")), ("STANDARD", "N", Decimal("16.05")),
    ("PROMO", "R", Decimal("11.40")),
]
RATE_SCHEMA = T.StructType([
    T.StructField("car_type", T.StringType(), False),
    T.StructField("insurance_type", T.StringType(), False),
    T.StructField("insurance_price", T.DecimalType(8, 2), False),
])


# Daily prices keyed by part type (the other types have none).
TYPE_PRICE_ROWS = [("ECONOMY", Decimal("21.50")), ("STANDARD", Decimal("33.25")),
                   ("PROMO", Decimal("78.10"))]
TYPE_PRICE_SCHEMA = T.StructType([
    T.StructField("car_type", T.StringType(), False),
    T.StructField("price_per_day", T.DecimalType(8, 2), False),
])


def type_prices(spark: SparkSession) -> DataFrame:
    return rows_frame(spark, TYPE_PRICE_ROWS, TYPE_PRICE_SCHEMA)


def offers(spark: SparkSession) -> DataFrame:
    return rows_frame(spark, OFFER_ROWS, OFFER_SCHEMA)


def rates(spark: SparkSession) -> DataFrame:
    return rows_frame(spark, RATE_ROWS, RATE_SCHEMA)


def _sql_value(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _sql_values(rows, schema: T.StructType, duck_types: list[str]) -> str:
    body = ",\n    ".join(
        "(" + ", ".join(f"CAST({_sql_value(v)} AS {t})" for v, t in zip(r, duck_types)) + ")"
        for r in rows)
    cols = ", ".join(f.name for f in schema.fields)
    return f"(VALUES\n    {body}) AS t({cols})"


OFFERS_SQL = ("SELECT * FROM " + _sql_values(
    OFFER_ROWS, OFFER_SCHEMA, ["VARCHAR", "DECIMAL(5,2)", "DECIMAL(8,2)", "VARCHAR", "VARCHAR"]))
RATES_SQL = ("SELECT * FROM " + _sql_values(
    RATE_ROWS, RATE_SCHEMA, ["VARCHAR", "VARCHAR", "DECIMAL(8,2)"]))

TYPE_PRICES_SQL = ("SELECT * FROM " + _sql_values(
    TYPE_PRICE_ROWS, TYPE_PRICE_SCHEMA, ["VARCHAR", "DECIMAL(8,2)"]))

# The same views for the DuckDB oracle, over the pre-registered tables.
USERS_SQL = """SELECT c_custkey AS license_no, c_name AS fname,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE substr(c_mktsegment, 1, 1) END AS mname,
       c_mktsegment AS lname,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email
FROM customer"""

RESERVATIONS_SQL = """SELECT o_orderkey AS reservation_id, o_custkey AS license_no,
       CASE o_orderstatus WHEN 'O' THEN 'Reserved' WHEN 'F' THEN 'Completed' ELSE 'Pending' END AS status,
       CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) AS end_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS actual_end_date,
       o_orderpriority AS promo_code, CAST(o_totalprice AS DECIMAL(12,2)) AS tot_amount,
       CAST(o_orderkey AS VARCHAR) AS vin
FROM orders"""

PAYMENTS_SQL = """SELECT l_orderkey AS reservation_id, l_linenumber AS line_no,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount_paid
FROM lineitem"""

RENTALS_SQL = """SELECT l_orderkey AS reservation_id, l_linenumber AS line_no, l_partkey AS vin,
       l_returnflag AS insurance_type, CAST(l_shipdate AS DATE) AS actual_end_date,
       l_suppkey AS drop_location_id, CAST(NULL AS DECIMAL(12,2)) AS penalty_amount,
       CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) AS end_date,
       o_orderpriority AS promo_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

PRICES_SQL = """SELECT p_partkey AS vin, p_type AS car_type,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price_per_day
FROM part"""

RENTED_PRICES_SQL = """SELECT p_name AS car_type, p_brand AS insurance_type,
       CAST(p_retailprice AS DECIMAL(8,2)) AS price_per_day
FROM part"""

CARS_SQL = """SELECT p_partkey AS vin, CAST(p_size AS BIGINT) AS rental_location_id,
       'Unavailable' AS status
FROM part"""


def with_views(body: str, *names: str) -> str:
    """Prefix an oracle query with the role views it uses."""
    views = {
        "users": USERS_SQL, "reservations": RESERVATIONS_SQL, "payments": PAYMENTS_SQL,
        "rentals": RENTALS_SQL, "prices": PRICES_SQL, "cars": CARS_SQL,
        "offers": OFFERS_SQL, "rates": RATES_SQL, "type_prices": TYPE_PRICES_SQL,
    }
    ctes = ",\n".join(f"{n} AS (\n{views[n]}\n)" for n in names)
    return f"WITH {ctes}\n{body}" if names else body
