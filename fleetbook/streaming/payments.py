"""Payments capped and reservations priced as they arrive.

Stateless streams. With lookup tables small enough to broadcast, each
micro-batch takes a stream-static left join and is appended to a parquet
sink; the file sink and the checkpoint together give exactly-once output.
Against a reservation table too large to broadcast, ``CappedPaymentWriter``
handles each batch in ``foreachBatch`` so that the big table is filtered by
the batch's keys instead of being shuffled for every batch.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetbook.operators.pricing import cap_payment, penalty_amount, rent_and_insurance
from fleetbook.plans.joins import broadcast_counted


def capped_payments(payments: DataFrame, totals: DataFrame, *, key: str = "reservation_id",
                    paid: str = "amount_paid", total: str = "tot_amount",
                    carry: Sequence[str] = ()) -> DataFrame:
    """The capping transform on a streaming (or batch) payment frame."""
    return cap_payment(payments, totals, key=key, paid=paid, total=total, carry=carry)


def start_to_parquet(stream: DataFrame, output_path: str, checkpoint_path: str,
                     available_now: bool = True, query_name: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder. ``available_now`` processes what
    has arrived and stops; otherwise the query keeps running."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", output_path).option("checkpointLocation", checkpoint_path))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def priced_rentals(reservations: DataFrame, cars: DataFrame, rates: DataFrame) -> DataFrame:
    """Late fee, rent and insurance set on each arriving reservation, by
    left joins to the cars (car, type, daily price) and the rates, one each
    (the before-insert pricing without the promotion, which depends on
    arrival order, see ``first_uses``)."""
    return rent_and_insurance(penalty_amount(reservations), cars, rates)


class PricedRentalWriter:
    """``foreachBatch`` handler: price each batch against a car table too large
    to broadcast. The batch's cars are broadcast into a semi join that reads
    the car table without a shuffle; the batch is then joined once to the few
    cars that it needs. Output as for ``CappedPaymentWriter``."""

    def __init__(self, cars: DataFrame, rates: DataFrame, output_path: str, *, vin: str = "vin"):
        self.cars, self.rates, self.output_path, self.vin = cars, rates, output_path, vin

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            keys = (batch.select(F.col(self.vin).alias("__bk")).where(F.col("__bk").isNotNull())
                    .distinct().persist())
            try:
                needed = self.cars.join(broadcast_counted(keys), F.col(self.vin) == F.col("__bk"), "left_semi")
                priced_rentals(batch, needed, self.rates).write.mode("overwrite").parquet(
                    os.path.join(self.output_path, f"batch_id={batch_id}"))
            finally:
                keys.unpersist()
        finally:
            batch.unpersist()


class CappedPaymentWriter:
    """``foreachBatch`` handler: cap each batch of payments against a
    reservation table too large to broadcast.

    A stream-static join plans a sort-merge join per micro-batch, and AQE
    does not re-plan streaming batches, so every batch would shuffle the
    whole reservation table. Here the batch (small) is cached, its distinct
    reservation keys are broadcast to a semi join that reads the
    reservation table without a shuffle and keeps only the matching rows,
    and the cap is applied between the two small sides. Output goes to
    ``output/batch_id=N`` by overwrite, so a retried batch rewrites its own
    files and is never counted twice.
    """

    def __init__(self, totals: DataFrame, output_path: str, *, key: str = "reservation_id",
                 paid: str = "amount_paid", total: str = "tot_amount",
                 carry: Sequence[str] = ()):
        self.totals = totals
        self.output_path = output_path
        self.key, self.paid, self.total, self.carry = key, paid, total, tuple(carry)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            keys = batch.select(F.col(self.key).alias("__bk")).where(
                F.col("__bk").isNotNull()).distinct().persist()
            try:
                relevant = self.totals.join(broadcast_counted(keys), F.col(self.key) == F.col("__bk"), "left_semi")
                out = cap_payment(batch, relevant, key=self.key, paid=self.paid,
                                  total=self.total, carry=self.carry)
                out.write.mode("overwrite").parquet(
                    os.path.join(self.output_path, f"batch_id={batch_id}"))
            finally:
                keys.unpersist()
        finally:
            batch.unpersist()


def run_foreach_batch(stream: DataFrame, handler, checkpoint_path: str) -> None:
    """Process everything that has arrived with ``handler``, then stop."""
    q = (stream.writeStream.foreachBatch(handler)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
