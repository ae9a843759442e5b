"""Analytic queries over the rental tables: projections, filters, joins,
aggregates and top-k.

Every function takes DataFrames plus the column names it works on (the
defaults are the rental table columns), and returns a DataFrame. They are
lazy but for those that may write a small side first (``rented_types_over_price``,
``not_in``, ``users_not_in``, ``users_without_exact_payment`` and
``overdue_with_user``), which run a job when called.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetbook.plans.joins import bounded_broadcast, distinct_side, null_aware_anti_join, small_side


def project_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, str],
                    alias: str | None = None) -> DataFrame:
    """``select a, b`` or ``select a as x``, optionally through a table alias
    (``from t as C`` / ``C.a``). Unselected columns are pruned from the scan."""
    if alias:
        df = df.alias(alias)

    def ref(name: str) -> Column:
        return F.col(f"{alias}.{name}") if alias else F.col(name)

    if isinstance(columns, Mapping):
        return df.select(*[ref(src).alias(dst) for src, dst in columns.items()])
    return df.select(*[ref(c) for c in columns])


def filter_above(df: DataFrame, column: str, threshold) -> DataFrame:
    """``where column > threshold``; pushed into the parquet scan."""
    return df.where(F.col(column) > F.lit(threshold))


def filter_not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``where column <> value`` with SQL's three-valued logic: NULLs are
    dropped as well (not the same as ``NOT (column <=> value)``)."""
    return df.where(F.col(column) != F.lit(value))


def overdue_reservations(res: DataFrame, as_of: _dt.date | Column | None = None, *,
                         status: str = "status", reserved: str = "Reserved",
                         end: str = "end_date", actual_end: str = "actual_end_date",
                         strict: bool | None = None) -> DataFrame:
    """Reservations still out after their end date: reserved, due before
    ``as_of`` (today by default) and with no actual return.

    With ``strict=False`` a rental due on the day itself is overdue. That is
    the default for today, which stands for a clock time after midnight; a
    date that is given is compared strictly.
    """
    if strict is None:
        strict = as_of is not None
    now = F.current_date() if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of))
    due = F.col(end) < now if strict else F.col(end) <= now
    return res.where((F.col(status) == reserved) & due & F.col(actual_end).isNull())


def join_payments(res: DataFrame, pay: DataFrame, *, key: str = "reservation_id",
                  total: str = "tot_amount", paid: str = "amount_paid") -> DataFrame:
    """Every payment next to its reservation's total (inner equi join)."""
    return (res.select(key, total)
            .join(pay.select(key, paid), key, "inner")
            .select(key, total, paid))


def rented_types_over_price(types: DataFrame, cars: DataFrame, reservations: DataFrame,
                            threshold, *, type_key: str = "car_type",
                            price: str = "price_per_day", car_type: str = "car_type",
                            car_vin: str = "vin", res_vin: str = "vin",
                            output: Sequence[str] = ("car_type", "price_per_day"),
                            one_per_car: bool = False) -> DataFrame:
    """Distinct car types dearer than ``threshold`` that have been rented.

    The reservation and car tables contribute existence only, so they enter
    as semi joins instead of multiplying rows before a DISTINCT. The rented
    cars are a distinct key set (partially aggregated, so a car that is
    rented all the time is one row per task; see ``distinct_side``). Where a
    car has one reservation at most (``one_per_car``) they are distinct as
    they are read.
    """
    rented = reservations.select(F.col(res_vin).alias("__vin"))
    rented = rented if one_per_car else distinct_side(rented)
    rented_cars = (cars.select(F.col(car_vin).alias("__vin"), F.col(car_type).alias("__type"))
                   .join(rented, "__vin", "left_semi"))
    rented_types = rented_cars.select("__type").distinct()
    return (types.where(F.col(price) > F.lit(threshold))
            .join(rented_types, F.col(type_key) == F.col("__type"), "left_semi")
            .select(*output).distinct())


def left_join_lookup(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                     right_filter: Column | None = None, suffix: str = "_r") -> DataFrame:
    """``select * from left l left join right r on l.a = r.b [and filter]``.

    Right columns whose name is also on the left get ``suffix`` so the
    result can be written and hashed. A filter on the right side is applied
    before the join, so it reaches the right scan.
    """
    if right_filter is not None:
        right = right.where(right_filter)
    clash = set(left.columns) & set(right.columns)
    right = right.select(*[F.col(c).alias(c + suffix if c in clash else c) for c in right.columns])
    cond = None
    for lc, rc in on:
        rc2 = rc + suffix if rc in clash else rc
        term = left[lc] == right[rc2]
        cond = term if cond is None else cond & term
    return left.join(right, cond, "left")


def exists_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              right_filter: Column | None = None) -> DataFrame:
    """``where exists (select 1 from right where right_key = left_key)``:
    a left semi join; left rows are kept once each. The right keys are
    de-duplicated first: the partial aggregate shrinks a key repeated many
    times (a part on many lines) to one row per task before the shuffle,
    and its output partitioning is the one the join needs."""
    if right_filter is not None:
        right = right.where(right_filter)
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    return left.join(keys, F.col(left_key) == F.col("__k"), "left_semi")


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``where left_key not in (select right_key from right)``."""
    return null_aware_anti_join(left, right, left_key, right_key)


def exactly_paid_reservations(res: DataFrame, pay: DataFrame, *, key: str = "reservation_id",
                              total: str = "tot_amount", paid: str = "amount_paid",
                              on_many: str = "raise") -> DataFrame:
    """Reservations whose total, looked up among the payments' amounts, leads
    back to themselves.

    The lookup is by amount alone and must give one reservation. Where
    several payments have the amount, ``on_many="raise"`` fails if any
    reservation asks for it, as a scalar subquery of several rows does;
    ``"min"`` takes the smallest reservation.

    Payments are reduced to one row per amount by a partial aggregate, and
    reservations are joined on (reservation, amount), a unique pair, so a
    popular amount never gathers reservations in one task. Repeated amounts
    are looked for between two sets of distinct amounts.
    """
    by_amount = (pay.groupBy(F.col(paid).alias("__amt"))
                 .agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__rid")))
    if on_many == "raise":
        asked = res.select(F.col(total).alias("__tot")).distinct()
        many = (by_amount.where(F.col("__n") > 1).join(asked, F.col("__amt") == F.col("__tot"), "left_semi")
                .agg(F.min("__amt").alias("m")).scalar())
        res = res.where(F.when(many.isNotNull(), F.raise_error(F.concat(
            F.lit("more than one payment matches amount "), many.cast("string"))).cast("boolean"))
            .otherwise(F.lit(True)))
    elif on_many != "min":
        raise ValueError(f"on_many: {on_many}")
    return res.join(by_amount, (F.col(total) == F.col("__amt")) & (F.col(key) == F.col("__rid")),
                    "inner").select(*res.columns)


def users_not_in(users: DataFrame, reservations: DataFrame, *, user_key: str = "license_no",
                 res_user: str = "license_no") -> DataFrame:
    """Users whose key is not among the reservations' user keys (``NOT IN``)."""
    return null_aware_anti_join(users, reservations, user_key, res_user)


def users_without_exact_payment(users: DataFrame, res: DataFrame, pay: DataFrame, *,
                                output: Sequence[str] = ("fname", "lname"),
                                on_many: str = "raise") -> DataFrame:
    """Users with no reservation settled by one payment of exactly its total."""
    paid = exactly_paid_reservations(res, pay, on_many=on_many)
    return users_not_in(users, paid).select(*output)


def max_reservation(res: DataFrame, *, key: str = "reservation_id",
                    amount: str = "tot_amount") -> DataFrame:
    """One row: the largest amount and the reservation holding it; on a tie
    the smallest id. A global aggregate with partial aggregation per task,
    so only one small row per task reaches the final step."""
    best = F.min(F.struct((-F.col(amount)).alias("na"), F.col(key).alias("k")))
    return (res.where(F.col(amount).isNotNull())
            .agg(best.alias("__b"))
            .select(F.col("__b.k").alias(key), (-F.col("__b.na")).alias(amount)))


def top_reservations(res: DataFrame, *, key: str = "reservation_id",
                     amount: str = "tot_amount") -> DataFrame:
    """All reservations at the maximum amount (ties kept), i.e.
    ``rank() over (order by amount desc) = 1`` without a single-task window:
    a global max (one row, broadcast) and an equi join on the amount."""
    top = res.agg(F.max(amount).alias("__max"))   # a global aggregate: exactly one row
    return (res.join(F.broadcast(top), F.col(amount) == F.col("__max"), "inner")
            .select(key, amount))


def overdue_with_user(res: DataFrame, users: DataFrame, *, user_key: str = "license_no",
                      res_user: str = "license_no",
                      user_cols: Sequence[str] = ("fname", "mname", "lname", "email"),
                      res_cols: Sequence[str] = ("reservation_id", "vin", "license_no"),
                      materialize_late: bool = True, **overdue_kwargs) -> DataFrame:
    """Overdue reservations with their user's row (one join instead of a
    lookup per cursor row).

    The overdue set is a selective filter of the reservations; with
    ``materialize_late`` it is written once to the shared checkpoint folder
    and, if proven small, broadcast, so the user table is read without a
    shuffle.
    """
    late = small_side(overdue_reservations(res, **overdue_kwargs).select(*res_cols),
                      materialize_late)
    u = users.select(F.col(user_key).alias("__uk"), *[c for c in user_cols if c != user_key])
    return late.join(u, F.col(res_user) == F.col("__uk"), "inner").drop("__uk")


def look_up_in_months(table: DataFrame, heads: DataFrame, month: str, key: str) -> DataFrame:
    """Rows of a table kept by ``month`` whose (month, key) is among ``heads``.
    The months of the heads prune the table's folders at run time, where
    the heads come from a filter and are small enough to be sent to all."""
    return table.join(bounded_broadcast(heads.select(month, key)), [month, key], "left_semi")


def promo_usage(offers: DataFrame, res: DataFrame, *, code: str = "promo_code",
                one_time: str = "is_one_time", res_code: str = "promo_code") -> DataFrame:
    """For each offer that is not one-time (``is_one_time <> 'Y'``, NULL flags
    excluded), how many reservations used its code; zero kept.

    Reservations are counted per code first, with partial aggregation, so a
    code used by a third of all reservations is still one row per task
    before the shuffle; the offers then take a left join to the counts.
    """
    counts = (res.where(F.col(res_code).isNotNull())
              .groupBy(F.col(res_code).alias("__code")).agg(F.count(F.lit(1)).alias("__n")))
    chosen = offers.where(F.col(one_time) != "Y").select(code)
    return (chosen.join(counts, F.col(code) == F.col("__code"), "left")
            .select(code, F.coalesce(F.col("__n"), F.lit(0)).cast("bigint").alias("times_used")))

