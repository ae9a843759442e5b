"""Set-based updates: settle paid reservations, raise insurance rates.

Parquet tables take no UPDATE or MERGE, so each operator returns the new
version of a table and the caller writes it to a new path. The three
settlement outputs are derived from one due set computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.functions.scalars import percent_increase
from fleetbook.plans.aggregates import pick_per_group
from fleetbook.plans.joins import small_side
from fleetbook.plans.runtime_filters import few, known_size


def paid_per_reservation(pay: DataFrame, *, key: str = "reservation_id",
                         paid: str = "amount_paid") -> DataFrame:
    """Sum of payments per reservation (partial aggregation before the
    shuffle, hash-partitioned on ``key`` afterwards)."""
    return pay.groupBy(key).agg(F.sum(paid).alias("__paid"))


def flag_due(res: DataFrame, pay: DataFrame, *, key: str = "reservation_id",
             status: str = "status", reserved: str = "Reserved",
             total: str = "tot_amount", paid: str = "amount_paid",
             flag: str = "__due") -> DataFrame:
    """Every reservation with a boolean ``flag``: still reserved and
    covered by the sum of its payments.

    The correlated sum becomes an aggregate (partial aggregation, then one
    shuffle on the key) left-joined to the reservations; the aggregate's
    output is already partitioned on the key, so only the reservations are
    shuffled for the join. No payments means a NULL sum: not due.
    """
    sums = paid_per_reservation(pay, key=key, paid=paid)
    due = (F.col(status) == reserved) & (F.col(total) <= F.col("__paid"))
    return (res.join(sums, key, "left")
            .withColumn(flag, F.coalesce(due, F.lit(False))).drop("__paid"))


def open_reservations(res: DataFrame, *, status: str = "status", reserved: str = "Reserved",
                      few_open: bool | None = False) -> DataFrame:
    """Reservations still reserved. Where they are few they are written once
    and filtered again, so that the planner knows their size and puts a Bloom
    filter of their keys on the other side of a join (see
    ``plans.runtime_filters``). ``few_open=None`` counts them first."""
    is_open = F.col(status) == reserved
    if few_open is None:
        few_open = few(res, is_open)
    return known_size(res.where(is_open)).where(is_open) if few_open else res.where(is_open)


def due_reservations(res: DataFrame, pay: DataFrame, *, key: str = "reservation_id",
                     status: str = "status", reserved: str = "Reserved",
                     total: str = "tot_amount", paid: str = "amount_paid",
                     few_open: bool | None = False) -> DataFrame:
    """Reservations still reserved whose payments together cover the total,
    with all their columns; without payments there is no sum to cover it.

    The status filter reaches the reservation scan before the inner join
    with the payment sums, which are partitioned on the key already. With
    ``few_open`` the open keys prune the payments before the sum and its
    shuffle.
    """
    sums = paid_per_reservation(pay, key=key, paid=paid)
    return (open_reservations(res, status=status, reserved=reserved, few_open=few_open)
            .join(sums, key, "inner")
            .where(F.col(total) <= F.col("__paid"))
            .select(*res.columns))


def settle_reservations(res: DataFrame, pay: DataFrame | None = None, *,
                        due: DataFrame | None = None, key: str = "reservation_id",
                        status: str = "status", reserved: str = "Reserved",
                        completed: str = "Completed", total: str = "tot_amount",
                        paid: str = "amount_paid", few_open: bool | None = False) -> DataFrame:
    """Reservation table with the due rows marked completed.

    Given the payments, this is one left join of the reservations to the
    payment sums. With ``few_open`` the due keys are found first, from the
    payments of open reservations alone, and written; so the payments are
    not all summed and the reservations not shuffled. Given a precomputed
    ``due`` set instead, its keys are joined back.
    """
    if due is None and few_open is None:
        few_open = few(res, F.col(status) == reserved)
    if due is None and few_open:
        due = small_side(due_reservations(res, pay, key=key, status=status, reserved=reserved, total=total,
                                          paid=paid, few_open=True).select(key))
    if due is None:
        flagged = flag_due(res, pay, key=key, status=status, reserved=reserved, total=total, paid=paid)
    else:
        due_keys = due.select(F.col(key).alias("__dk"), F.lit(True).alias("__due"))
        flagged = res.join(due_keys, F.col(key) == F.col("__dk"), "left").drop("__dk")
    return (flagged.withColumn(status, F.when(F.col("__due"), F.lit(completed))
                               .otherwise(F.col(status)))
            .drop("__due"))


def settle_offers(offers: DataFrame, due: DataFrame, *, code: str = "promo_code",
                  status: str = "status", one_time: str = "is_one_time",
                  res_code: str = "promo_code") -> DataFrame:
    """Offer table with every one-time offer used by a due reservation expired."""
    # One row per used code after a partial distinct; AQE sees its measured
    # size and broadcasts it without an extra probe of the due set.
    used = (due.where(F.col(res_code).isNotNull())
            .select(F.col(res_code).alias("__u")).distinct())
    out = offers.join(used, F.col(code) == F.col("__u"), "left")
    hit = (F.col(one_time) == "Y") & F.col("__u").isNotNull()
    return out.withColumn(status, F.when(hit, F.lit("Expired")).otherwise(F.col(status))).drop("__u")


def settle_cars(cars: DataFrame, due_rentals: DataFrame, *, vin: str = "vin",
                location: str = "rental_location_id", status: str = "status",
                res_key: str = "reservation_id", res_vin: str = "vin",
                drop: str = "drop_location_id", available: str = "Available",
                small_winner: bool = False) -> DataFrame:
    """Car table with each car of a due reservation moved to the drop
    location and made available.

    When several due reservations name one car, the one with the highest
    reservation id wins (then the highest drop location); the winner comes
    from hash aggregates with partial aggregation, never a sort of the
    car's rows. A NULL drop
    location is written as NULL; the not-null check reports it.
    """
    per_res = (due_rentals.groupBy(F.col(res_vin).alias("__v"), F.col(res_key).alias("__k"))
               .agg(F.max(drop).alias("__d")))
    winner = pick_per_group(per_res, "__v", ["__k"], "__d", last=True, out="__drop")
    # one row per moved car; when few cars move, broadcasting it keeps the
    # car table from being shuffled
    winner = small_side(winner, small_winner)
    out = cars.join(winner, F.col(vin) == F.col("__v"), "left")
    moved = F.col("__v").isNotNull()
    return (out.withColumn(location, F.when(moved, F.col("__drop")).otherwise(F.col(location)))
            .withColumn(status, F.when(moved, F.lit(available)).otherwise(F.col(status)))
            .drop("__v", "__drop"))


def settle(res: DataFrame, pay: DataFrame, offers: DataFrame, cars: DataFrame, *,
           cut_lineage: bool = False, few_open: bool | None = False) -> dict[str, DataFrame]:
    """All three settlement outputs from one pass over reservations and
    payments. With ``cut_lineage`` the due rows are written first, only the
    columns that the outputs need (key, car, code, drop location), so the
    outputs read those instead of summing the payments again; the
    reservation table is then one join, written once."""
    due = due_reservations(res, pay, few_open=few_open).select(
        "reservation_id", "vin", "promo_code", "drop_location_id")
    due = small_side(due, cut_lineage)
    return {
        "reservation": settle_reservations(res, due=due),
        "offer_details": settle_offers(offers, due),
        "car": settle_cars(cars, due, small_winner=cut_lineage),
    }


def raise_rates(rates: DataFrame, percentage, *, price: str = "insurance_price",
                dtype: T.DataType | None = None) -> DataFrame:
    """Every rate raised by ``percentage`` percent, rounded half up to the
    column's scale."""
    dtype = dtype or rates.schema[price].dataType
    return rates.withColumn(price, percent_increase(price, percentage).cast(dtype))
