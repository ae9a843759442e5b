"""Payments capped, and rentals priced, while both sides arrive.

A payment may come before the reservation that it pays. Both are streams
here, joined on the reservation key in a state store: a row of either side
is kept until its partner comes or the watermark has passed the time in
which it may come.

* A payment meets its reservation when their times are at most ``wait``
  apart, whichever comes first; it is then capped at the total at once.
* A payment whose reservation has not come by then is handed on as it is, as
  a payment for an unknown reservation.
* A row is late when its time lies more than ``delay`` before the newest
  one seen on the slower stream. Spark drops late rows before the join, and
  rows without a time cannot be kept by it. None is lost: ``missing_payments``
  finds every payment that the stream did not hand on, and caps it in batch.

The same holds for rentals and the cars that they rent: a rental may be
booked before its car is listed, and is priced when that comes.
Reservations and cars are keyed by their ids, one row each.

A state store costs several point reads and writes a row. Where batches are
large (a replay, a stream that catches up), ``ArrivalWriter`` runs the same
joins batch by batch with the waiting rows of both sides in parquet files, so
that a batch is sorted and merged instead.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.functions.scalars import days_between
from fleetbook.operators.pricing import LONG_AMOUNT, cap_payment, penalty_amount
from fleetbook.plans.joins import bounded_broadcast
from fleetbook.sources.tables import delete_path, path_exists
from fleetbook.streaming.payments import priced_rentals

SALTS = 4


def _met(left: DataFrame, right: DataFrame, left_key: str, left_time: str, wait: str, delay: str,
         salt_by: str | None, salts: int, how: str = "leftOuter") -> DataFrame:
    """Stream-stream left outer join (``how``: another) of ``left`` to ``right`` (key ``__rk``, time
    ``__rt``) where the times are at most ``wait`` apart. The left rows of a
    key are spread over ``salts`` tasks by a hash of ``salt_by``, and the right
    row is kept in each."""
    left = left.where(F.col(left_time).isNotNull()).withWatermark(left_time, delay)
    right = right.where(F.col("__rt").isNotNull()).withWatermark("__rt", delay)
    gap = F.expr(f"INTERVAL {wait}")
    match = ((F.col(left_key) == F.col("__rk")) & (F.col("__rt") >= F.col(left_time) - gap)
             & (F.col("__rt") <= F.col(left_time) + gap))
    if salt_by is not None:
        left = left.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
        right = right.withColumn("__rsalt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        match = match & (F.col("__salt") == F.col("__rsalt"))
    return left.join(right, match, how)


def capped_on_arrival(payments: DataFrame, reservations: DataFrame, *, pay_time: str, res_time: str,
                      wait: str, delay: str, key: str = "reservation_id", paid: str = "amount_paid",
                      total: str = "tot_amount", salt_by: str | None = None, salts: int = SALTS,
                      met_as: str | None = None) -> DataFrame:
    """Every payment once, its amount capped at the total of its reservation:
    a stream-stream left outer join with a watermark on both sides.

    ``wait`` and ``delay`` are intervals ('3 days'). With ``salt_by`` (a column
    that tells payments of one reservation apart) the payments of a
    reservation are spread over ``salts`` tasks and the reservation is kept
    in each, so that a reservation with very many payments does not fill one
    task and its state store. ``met_as`` names a column that tells whether the
    reservation has come.
    """
    totals = reservations.select(F.col(key).alias("__rk"), F.col(total).alias("__tot"), F.col(res_time).alias("__rt"))
    met = _met(payments, totals, key, pay_time, wait, delay, salt_by, salts)
    capped = F.when(F.col(paid) > F.col("__tot"), F.col("__tot")).otherwise(F.col(paid))
    out = met.withColumn(paid, capped.cast(payments.schema[paid].dataType))
    return out.select(*payments.columns, *([F.col("__rk").isNotNull().alias(met_as)] if met_as else []))


def missing_payments(payments: DataFrame, handed_on: DataFrame, reservations: DataFrame, ids: Sequence[str],
                     *, key: str = "reservation_id", paid: str = "amount_paid",
                     total: str = "tot_amount") -> DataFrame:
    """Payments that the stream did not hand on (late rows, rows without a
    time), capped in batch against all reservations. ``ids`` tells
    payments apart. Run it when the stream has passed the payments given."""
    rest = payments.join(handed_on.select(*ids).distinct(), list(ids), "left_anti")
    return cap_payment(rest, reservations, key=key, paid=paid, total=total).select(*payments.columns)


def priced_on_arrival(rentals: DataFrame, cars: DataFrame, rates: DataFrame, *, rent_time: str, car_time: str,
                      wait: str, delay: str, vin: str = "vin", salt_by: str | None = None,
                      salts: int = SALTS, met_as: str | None = None) -> DataFrame:
    """Late fee, rent and insurance of every rental once, as the rentals and
    the ``cars`` (vin, car_type, price_per_day) both arrive: a stream-stream
    left outer join; the rates are a static table. A rental whose car has not
    come within ``wait`` is handed on without rent and insurance, as one of an
    unknown car. ``salt_by`` and ``met_as`` as for ``capped_on_arrival``: a car
    may be in a third of the rentals."""
    terms = cars.select(F.col(vin).alias("__rk"), F.col("car_type").alias("__ctype"),
                        F.col("price_per_day").alias("__price"), F.col(car_time).alias("__rt"))
    met = penalty_amount(_met(rentals, terms, vin, rent_time, wait, delay, salt_by, salts))
    covers = bounded_broadcast(rates.select(F.col("car_type").alias("__rct"), F.col("insurance_type").alias("__rit"),
                                            F.col("insurance_price").alias("__rate")))
    days = days_between("actual_end_date", "start_date")
    out = met.join(covers, (F.col("__ctype") == F.col("__rct")) & (F.col("insurance_type") == F.col("__rit")), "left")
    out = (out.withColumn("rental_amount", (F.col("__price") * days).cast(LONG_AMOUNT))
           .withColumn("insurance_amount", (F.col("__rate") * days).cast(LONG_AMOUNT)))
    if met_as:
        out = out.withColumn(met_as, F.col("__rk").isNotNull())
    return (out.drop("__rk", "__rt", "__salt", "__rsalt", "__ctype", "__price", "__rct", "__rit", "__rate"))


def missing_rentals(rentals: DataFrame, handed_on: DataFrame, cars: DataFrame, rates: DataFrame,
                    ids: Sequence[str]) -> DataFrame:
    """Rentals that the stream did not hand on, priced in batch against all
    cars (see ``missing_payments``)."""
    rest = rentals.join(handed_on.select(*ids).distinct(), list(ids), "left_anti")
    return priced_rentals(rest, cars, rates).select(*handed_on.columns)


def both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one for ``ArrivalWriter``: each row in the column of its side."""
    return (left.select(F.lit(True).alias("__is_left"), F.struct(*left.columns).alias("__l"),
                        F.lit(None).cast(right.schema).alias("__r"))
            .unionAll(right.select(F.lit(False), F.lit(None).cast(left.schema), F.struct(*right.columns))))


class ArrivalWriter:
    """``foreachBatch`` handler over ``both_sides`` for ``join``
    (``capped_on_arrival`` or ``priced_on_arrival`` with their arguments):
    every row of the left side once, when its partner has come or can come no
    more.

    * A new left row is joined to the right rows that wait and the new ones, a
      waiting left row to the new ones.
    * The watermark is the newest time of the slower side less ``delay``. Rows
      that came behind the one of the batch before are late and dropped.
    * Left rows whose ``wait`` it has passed are handed on unmet, unless they
      have met a partner; the rows of both sides that it has not passed go to
      ``state/batch_id=N``, a left row with a mark when it has met one.
    * Output and state of a batch are overwritten as a whole, so a retried
      batch rewrites the same files and never doubles its output.
    """

    def __init__(self, join: Callable[..., DataFrame], output_path: str, state_path: str, *, key: str,
                 left_time: str, right_time: str, wait: str, delay: str, salt_by: str | None = None,
                 salts: int = SALTS):
        self.join, self.output_path, self.state_path = join, output_path, state_path
        self.key, self.left_time, self.right_time = key, left_time, right_time
        self.wait, self.delay, self.salt_by, self.salts = wait, delay, salt_by, salts

    def _state(self, batch_id: int) -> str:
        return os.path.join(self.state_path, f"batch_id={batch_id}")

    def _newest(self, spark: SparkSession, batch_id: int) -> list[int | None]:
        """The newest time of each side before this batch, in microseconds. A
        missing version is an error: the rows that wait would be lost."""
        if batch_id == 0:
            return [None, None]
        if not path_exists(spark, self._state(batch_id - 1)):
            raise RuntimeError(f"no state of the batch before: {self._state(batch_id - 1)}")
        return list(spark.read.schema("l long, r long").parquet(f"{self._state(batch_id - 1)}/newest").first())

    def _passed(self, newest: Sequence[int | None]) -> Column | None:
        if None in newest:
            return None
        return F.timestamp_micros(F.lit(min(newest))) - F.expr(f"INTERVAL {self.delay}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, wait = batch.sparkSession, F.expr(f"INTERVAL {self.wait}")
        left_time, right_time = F.col(self.left_time), F.col(self.right_time)
        left = batch.where("__is_left").select("__l.*").where(left_time.isNotNull())
        right = batch.where(~F.col("__is_left")).select("__r.*").where(right_time.isNotNull())

        before = self._newest(spark, batch_id)
        found = [t.agg(F.unix_micros(F.max(c))).first()[0] for t, c in ((left, left_time), (right, right_time))]
        newest = [max((x for x in pair if x is not None), default=None) for pair in zip(before, found)]
        late, passed = self._passed(before), self._passed(newest)
        if late is not None:
            left, right = left.where(left_time > late), right.where(right_time > late)

        left = left.withColumn("__had", F.lit(False))
        lefts, rights = left, right
        out = None
        if batch_id > 0:
            old_left = spark.read.schema(left.schema).parquet(f"{self._state(batch_id - 1)}/left")
            lefts, rights = left.unionByName(old_left), right.unionByName(
                spark.read.schema(right.schema).parquet(f"{self._state(batch_id - 1)}/right"))
            out = self.join(old_left, right, met_as="__met")
        fresh = self.join(left, rights, met_as="__met")
        out = fresh if out is None else fresh.unionByName(out)
        gone = F.lit(False) if passed is None else left_time <= passed - wait
        (out.where(F.col("__met") | (~F.col("__had") & gone)).drop("__met", "__had")
         .write.mode("overwrite").parquet(os.path.join(self.output_path, f"batch_id={batch_id}")))

        near = rights
        if passed is not None:
            lefts, rights = lefts.where(left_time > passed - wait), rights.where(right_time > passed - wait)
            near = near.where(right_time > passed - wait - wait)
        self._keep(lefts, near).write.mode("overwrite").parquet(f"{self._state(batch_id)}/left")
        rights.write.mode("overwrite").parquet(f"{self._state(batch_id)}/right")
        (spark.range(1).select(*(F.lit(x).cast("long").alias(c) for x, c in zip(newest, "lr")))
         .write.mode("overwrite").parquet(f"{self._state(batch_id)}/newest"))
        # a retry of this batch reads the version before it; older ones are done with
        delete_path(spark, self._state(batch_id - 2))

    def _keep(self, lefts: DataFrame, rights: DataFrame) -> DataFrame:
        """The left rows that wait, marked when they have met a partner."""
        partners = rights.select(F.col(self.key).alias("__rk"), F.col(self.right_time).alias("__rt"))

        def part(how: str) -> DataFrame:
            return _met(lefts.where("NOT __had"), partners, self.key, self.left_time, self.wait, self.delay,
                        self.salt_by, self.salts, how).select(*lefts.columns)

        return (lefts.where("__had").unionByName(part("left_semi").withColumn("__had", F.lit(True)))
                .unionByName(part("left_anti")))
