"""Arg-min / arg-max per group that stays on hash aggregation.

``min(struct(order, key))`` per group gives the first row deterministically,
but Spark cannot keep a struct in a hash-aggregation buffer and plans it as
a sort aggregate, which sorts every map task's input. With one ordering
column the same answer comes from two hash aggregates, each partially
aggregated before its shuffle and inside whole-stage codegen:

1. per ``(group, order)``: ``min(key)`` (or ``max``), which also collapses a
   hot group to one row per distinct order value per task;
2. per ``group``: ``min_by(key, order)``, now unique per ``(group, order)``,
   so the choice is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_per_group(df: DataFrame, group: str, order_by: Sequence[str], value: str, *,
                   last: bool = False, out: str | None = None) -> DataFrame:
    """``(group, out)``: the ``value`` of the first row per group in
    ``(order_by..., value)`` order, or of the last row with ``last=True``.
    A NULL order value comes after all others (before them with
    ``last=True``, so it is never preferred): such a row is picked only when
    its group has no other."""
    out = out or value
    order_by = list(order_by)
    best = F.max if last else F.min
    if len(order_by) == 1:
        o = order_by[0]
        per_order = df.groupBy(group, o).agg(best(value).alias("__pick_v"))
        pick = F.max_by if last else F.min_by  # both skip NULL orders
        unordered = best(F.when(F.col(o).isNull(), F.col("__pick_v")))
        return per_order.groupBy(group).agg(
            F.when(F.count(o) > 0, pick("__pick_v", o)).otherwise(unordered).alias(out))
    known = [F.col(c).isNotNull() if last else F.col(c).isNull() for c in order_by]
    ordered = F.struct(*[x.alias(f"__o{i}_{j}") for i, (k, c) in enumerate(zip(known, order_by))
                         for j, x in enumerate((k, F.col(c)))], F.col(value).alias("__pick_v"))
    return df.groupBy(group).agg(best(ordered).alias("__pick_s")).select(
        group, F.col("__pick_s.__pick_v").alias(out))
