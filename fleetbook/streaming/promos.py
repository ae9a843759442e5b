"""One-time offers used up across micro-batches.

A one-time code gives its discount to the first reservation that uses it;
every later use, in the same batch or any later one, sees it expired. The
rule depends on arrival order, so each batch is handled by ``foreachBatch``:

* the codes used before this batch are read from the previous state version;
* within the batch, the first arrival per code is a partial aggregate
  (``pick_per_group``), a few rows per code per task, so a code used by a
  third of the batch never gathers its rows in one task;
* flagged rows go to ``output/batch_id=N`` and the grown code set to
  ``state/batch_id=N``, both overwritten as a whole, so a retried batch
  rewrites the same files and never doubles its output.

The code set holds one row per offer, which is what makes it safe to
broadcast.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.plans.aggregates import pick_per_group
from fleetbook.plans.joins import bounded_broadcast, broadcast_counted
from fleetbook.sources.tables import delete_path, path_exists


class OneTimeOfferUse:
    """``foreachBatch`` handler flagging which rows got a one-time offer.

    ``offers`` (optional, static) lists ``code``, ``is_one_time`` and
    ``status``; without it every code is a one-time offer that starts out
    available.
    """

    def __init__(self, output_path: str, state_path: str, order_by: Sequence[str], *,
                 key: str, code: str, flag: str = "promo_available",
                 offers: DataFrame | None = None):
        self.output_path = output_path
        self.state_path = state_path
        self.order_by = list(order_by)
        self.key = key
        self.code = code
        self.flag = flag
        self.offers = offers

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The codes used before this batch. A missing version is an error:
        reading it as empty would give every code out again."""
        prev = os.path.join(self.state_path, f"batch_id={batch_id - 1}")
        if batch_id > 0:
            if not path_exists(spark, prev):
                raise RuntimeError(f"no state of the batch before: {prev}")
            return spark.read.parquet(prev)
        return spark.createDataFrame([], f"{self.code} string").select(
            F.col(self.code).cast("string"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read by the first-use aggregate, the flags and the state
        try:
            self._flag(spark, batch, batch_id)
        finally:
            batch.unpersist()

    def _flag(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        used = bounded_broadcast(self._state(spark, batch_id).select(
            F.col(self.code).alias("__used")))
        firsts = pick_per_group(batch.select(F.col(self.code).alias("__fc"), self.key,
                                             *self.order_by),
                                "__fc", self.order_by, self.key, out="__fk")
        firsts = firsts.join(used, F.col("__fc") == F.col("__used"), "left_anti")
        # One row per code; the probe reads the cached batch, not the source.
        firsts = broadcast_counted(firsts)
        flagged = batch.join(firsts, (F.col(self.key) == F.col("__fk"))
                             & (F.col(self.code) == F.col("__fc")), "left")
        got_first = F.col("__fk").isNotNull()
        if self.offers is not None:
            o = self.offers.select(F.col(self.code).alias("__oc"),
                                   F.col("is_one_time").alias("__one"),
                                   F.col("status").alias("__st"))
            flagged = flagged.join(bounded_broadcast(o), F.col(self.code) == F.col("__oc"), "left")
            avail = (F.col("__st") == "Available") & F.when(
                F.col("__one") == "Y", got_first).otherwise(F.lit(True))
        else:
            avail = got_first
        out = (flagged.withColumn(self.flag, F.when(avail, 1).otherwise(0))
               .drop("__fc", "__fk", "__oc", "__one", "__st"))
        out.write.mode("overwrite").parquet(os.path.join(self.output_path, f"batch_id={batch_id}"))
        grown = (used.select(F.col("__used").alias(self.code))
                 .unionByName(firsts.where(F.col("__fk").isNotNull() & F.col("__fc").isNotNull())
                              .select(F.col("__fc").cast("string").alias(self.code)))
                 .distinct())
        grown.write.mode("overwrite").parquet(os.path.join(self.state_path, f"batch_id={batch_id}"))
        # a retry of this batch reads the version before it; older ones are done with
        delete_path(spark, os.path.join(self.state_path, f"batch_id={batch_id - 2}"))


def run_batches(stream: DataFrame, handler: OneTimeOfferUse, checkpoint_path: str) -> None:
    """Process everything that has arrived, then stop."""
    q = (stream.writeStream.foreachBatch(handler)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def replay_in_time_slices(table: DataFrame, ts: str, slices: int, source_path: str,
                          after_each) -> None:
    """Feed ``table`` into the stream folder ``source_path`` as ``slices``
    time-ordered appends, calling ``after_each(i)`` after each one (e.g. to
    run the stream on what has arrived). Slices are range predicates on
    ``ts``, which reach the parquet reader; rows without a time go to the
    last slice, so every row is fed exactly once."""
    lo, hi = table.agg(F.min(ts), F.max(ts)).first()
    step = (hi - lo) / slices if lo is not None else None
    for i in range(slices):
        cond = F.lit(True)
        if step is not None and i > 0:
            cond = F.col(ts) >= F.lit(lo + step * i).cast(table.schema[ts].dataType)
        if step is not None and i < slices - 1:
            cond = cond & (F.col(ts) < F.lit(lo + step * (i + 1)).cast(table.schema[ts].dataType))
        if i == slices - 1:
            cond = cond | F.col(ts).isNull()
        elif step is None:
            continue
        table.where(cond).write.mode("append").parquet(source_path)
        after_each(i)
