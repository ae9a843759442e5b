"""Reservation pricing and payment capping, as set-based transforms.

Each function takes a DataFrame of new rows and returns it with one column
(re)computed, the way a before-insert row hook would have set it. They are
left joins against lookup tables, so the same code runs on a batch or on a
stream joined to static tables.

Dependency order when combined: penalty, rent and insurance first, then the
total, which reads all three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.functions.scalars import days_between, percent_discount
from fleetbook.plans.aggregates import pick_per_group
from fleetbook.plans.joins import bounded_broadcast, is_small

AMOUNT = T.DecimalType(12, 2)
LONG_AMOUNT = T.DecimalType(18, 2)
LATE_FEE_PER_DAY = 50


def penalty_amount(res: DataFrame, *, actual_end: str = "actual_end_date",
                   end: str = "end_date", penalty: str = "penalty_amount",
                   per_day: int = LATE_FEE_PER_DAY, dtype: T.DataType = AMOUNT) -> DataFrame:
    """Late fee of ``per_day`` per day from the due date to the actual
    return. An early return or a missing return date keeps the row's own
    value."""
    days = days_between(actual_end, end)
    fee = (days * F.lit(per_day)).cast(dtype)
    return res.withColumn(penalty, F.when(days >= 0, fee).otherwise(F.col(penalty).cast(dtype)))


def car_prices(cars: DataFrame, car_types: DataFrame, *, vin: str = "vin",
               car_type: str = "car_type", price: str = "price_per_day") -> DataFrame:
    """Daily price per car: car → type → price, left so an unknown type
    gives NULL. The type table is a dimension, broadcast when proven small."""
    types = bounded_broadcast(car_types.select(F.col(car_type).alias("__t"), price))
    return (cars.select(vin, car_type)
            .join(types, F.col(car_type) == F.col("__t"), "left")
            .select(vin, car_type, price))


def rent_amount(res: DataFrame, prices: DataFrame, *, vin: str = "vin",
                start: str = "start_date", actual_end: str = "actual_end_date",
                rent: str = "rental_amount", price: str = "price_per_day",
                dtype: T.DataType = LONG_AMOUNT) -> DataFrame:
    """Rent = daily price × days from start to actual return. A same-day
    return is 0; no return yet, or no price, gives NULL."""
    p = bounded_broadcast(prices.select(F.col(vin).alias("__vin"), F.col(price).alias("__price")))
    out = res.join(p, F.col(vin) == F.col("__vin"), "left")
    amount = (F.col("__price") * days_between(actual_end, start)).cast(dtype)
    return out.withColumn(rent, amount).drop("__vin", "__price")


def insurance_amount(res: DataFrame, car_types: DataFrame, rates: DataFrame, *,
                     vin: str = "vin", car_type: str = "car_type",
                     insurance_type: str = "insurance_type",
                     rate: str = "insurance_price", start: str = "start_date",
                     actual_end: str = "actual_end_date", out_col: str = "insurance_amount",
                     dtype: T.DataType = LONG_AMOUNT) -> DataFrame:
    """Insurance = rate for (car type, insurance type) × days rented.

    ``car_types`` maps each car to its type. The rate table is keyed on two
    columns; a missing rate gives NULL.
    """
    types = bounded_broadcast(car_types.select(F.col(vin).alias("__vin"),
                                               F.col(car_type).alias("__ctype")))
    r = bounded_broadcast(rates.select(F.col(car_type).alias("__rt"),
                                       F.col(insurance_type).alias("__ri"),
                                       F.col(rate).alias("__rate")))
    out = (res.join(types, F.col(vin) == F.col("__vin"), "left")
              .join(r, (F.col("__ctype") == F.col("__rt"))
                    & (F.col(insurance_type) == F.col("__ri")), "left"))
    amount = (F.col("__rate") * days_between(actual_end, start)).cast(dtype)
    return out.withColumn(out_col, amount).drop("__vin", "__ctype", "__rt", "__ri", "__rate")


def rent_and_insurance(res: DataFrame, cars: DataFrame, rates: DataFrame, *, vin: str = "vin",
                       car_type: str = "car_type", price: str = "price_per_day",
                       insurance_type: str = "insurance_type", rate: str = "insurance_price",
                       start: str = "start_date", actual_end: str = "actual_end_date",
                       rent: str = "rental_amount", insurance: str = "insurance_amount",
                       dtype: T.DataType = LONG_AMOUNT) -> DataFrame:
    """``rent_amount`` and ``insurance_amount`` from one join to ``cars`` (car,
    type, daily price): one shuffle of the rows when the cars are too many to
    broadcast, whose hot cars AQE can split."""
    terms = bounded_broadcast(cars.select(F.col(vin).alias("__vin"), F.col(car_type).alias("__ctype"),
                                          F.col(price).alias("__price")))
    r = bounded_broadcast(rates.select(F.col(car_type).alias("__rt"),
                                       F.col(insurance_type).alias("__ri"),
                                       F.col(rate).alias("__rate")))
    days = days_between(actual_end, start)
    out = (res.join(terms, F.col(vin) == F.col("__vin"), "left")
              .join(r, (F.col("__ctype") == F.col("__rt"))
                    & (F.col(insurance_type) == F.col("__ri")), "left"))
    return (out.withColumn(rent, (F.col("__price") * days).cast(dtype))
            .withColumn(insurance, (F.col("__rate") * days).cast(dtype))
            .drop("__vin", "__ctype", "__price", "__rt", "__ri", "__rate"))


def first_uses(res: DataFrame, offers: DataFrame, order_by: Sequence[str], *,
               key: str = "reservation_id", code: str = "promo_code",
               one_time: str = "is_one_time") -> DataFrame:
    """For every one-time offer, the reservation that used it first in
    arrival order ``order_by`` (then ``key``), as ``(code, key)``.

    The first use is a partial aggregate (``pick_per_group``): each task
    keeps one row per code and arrival value, so a code used by a third of
    all reservations never gathers its rows in one task. The result has at
    most one row per one-time offer.
    """
    one_time_codes = offers.where(F.col(one_time) == "Y").select(F.col(code).alias("__c"))
    used = res.join(bounded_broadcast(one_time_codes), F.col(code) == F.col("__c"), "left_semi")
    return pick_per_group(used, code, order_by, key)


def offer_available_flag(res: DataFrame, offers: DataFrame, order_by: Sequence[str], *,
                         key: str = "reservation_id", code: str = "promo_code",
                         status: str = "status", one_time: str = "is_one_time",
                         flag: str = "promo_available",
                         extra: Sequence[str] = ("percentage", "discounted_amount"),
                         arrivals: DataFrame | None = None) -> DataFrame:
    """Attach the offer's terms and whether it was available when this
    reservation arrived.

    A one-time code expires on its first use, but that use still reads the
    status before it changes, so the first arrival gets the offer and the
    later ones see it expired. Offers absent from the table give NULL terms
    and a NULL flag. First uses are found among ``arrivals`` (default
    ``res``): pass the reservation table when ``res`` holds several rows
    per reservation (rental lines), so the order of arrival is decided once
    per reservation and the line plan is not computed twice.
    """
    terms = offers.select(F.col(code).alias("__oc"), F.col(status).alias("__ostatus"),
                          F.col(one_time).alias("__oone"), *extra)
    firsts = first_uses(res if arrivals is None else arrivals, offers, order_by, key=key,
                        code=code, one_time=one_time)
    firsts = firsts.select(F.col(key).alias("__fk"), F.lit(True).alias("__first"))
    # The first-use table has at most one row per offer, so one bounded probe
    # of the offer table covers both broadcasts.
    if is_small(offers):
        terms, firsts = F.broadcast(terms), F.broadcast(firsts)
    out = (res.join(terms, F.col(code) == F.col("__oc"), "left")
              .join(firsts, F.col(key) == F.col("__fk"), "left"))
    is_one_time = F.col("__oone") == "Y"
    available = (F.col("__ostatus") == "Available") & (
        F.when(is_one_time, F.coalesce(F.col("__first"), F.lit(False))).otherwise(F.lit(True)))
    return out.withColumn(flag, available).drop("__oc", "__ostatus", "__oone", "__fk", "__first")


def total_after_offer(base: Column, percentage: Column, discounted: Column,
                      available: Column) -> Column:
    """``base`` less the offer's discount: its share of ``base``, or its fixed
    amount where it has no percentage. An offer that is unknown or not
    available takes nothing off; one that is available but has neither gives
    NULL."""
    reduced = F.coalesce(percent_discount(base, percentage), base - discounted)
    return F.when(available, reduced).otherwise(base)


def price_total(res: DataFrame, offers: DataFrame, order_by: Sequence[str], *,
                key: str = "reservation_id", code: str = "promo_code",
                parts: Sequence[str] = ("rental_amount", "insurance_amount", "penalty_amount"),
                total: str = "tot_amount", dtype: T.DataType = AMOUNT,
                arrivals: DataFrame | None = None) -> DataFrame:
    """Set the total: sum of ``parts`` (any NULL part makes it NULL), less
    the promotion available at the reservation's arrival (first uses found
    among ``arrivals``, default ``res``)."""
    flagged = offer_available_flag(res, offers, order_by, key=key, code=code,
                                   extra=("percentage", "discounted_amount"),
                                   arrivals=arrivals)
    base = None
    for p in parts:
        base = F.col(p) if base is None else base + F.col(p)
    amount = total_after_offer(base, F.col("percentage"), F.col("discounted_amount"),
                               F.col("promo_available"))
    return (flagged.withColumn(total, amount.cast(dtype))
            .drop("percentage", "discounted_amount", "promo_available"))


def expire_offers(offers: DataFrame, res: DataFrame, *, code: str = "promo_code",
                  status: str = "status", one_time: str = "is_one_time",
                  res_code: str = "promo_code") -> DataFrame:
    """Offer table after the reservations arrived: every one-time offer
    that was used at least once is 'Expired'; the others keep their status."""
    used = res.where(F.col(res_code).isNotNull()).select(F.col(res_code).alias("__u")).distinct()
    flagged = offers.join(used, F.col(code) == F.col("__u"), "left")
    new_status = F.when((F.col(one_time) == "Y") & F.col("__u").isNotNull(),
                        F.lit("Expired")).otherwise(F.col(status))
    return flagged.withColumn(status, new_status).drop("__u")


def cap_payment(pay: DataFrame, res: DataFrame, *, key: str = "reservation_id",
                paid: str = "amount_paid", total: str = "tot_amount",
                carry: Sequence[str] = ()) -> DataFrame:
    """Cap each payment at its reservation's total (each payment alone, not
    against the balance). A payment for an unknown reservation is kept.
    ``carry`` names reservation columns to bring along from the same join.
    Works unchanged on a streaming ``pay`` (stream-static left join)."""
    totals = res.select(F.col(key).alias("__rk"), F.col(total).alias("__tot"), *carry)
    out = pay.join(totals, F.col(key) == F.col("__rk"), "left")
    capped = F.when(F.col(paid) > F.col("__tot"), F.col("__tot")).otherwise(F.col(paid))
    return out.withColumn(paid, capped.cast(pay.schema[paid].dataType)).drop("__rk", "__tot")


def price_reservations(res: DataFrame, cars: DataFrame, car_types: DataFrame,
                       rates: DataFrame, offers: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Penalty, rent, insurance, then the total, on rental-table columns."""
    out = rent_and_insurance(penalty_amount(res), car_prices(cars, car_types), rates)
    return price_total(out, offers, order_by)
