"""Join strategies the optimizer cannot choose safely on its own.

* ``bounded_broadcast``: broadcast a side only after its rows and bytes have
  been proven below a bound; otherwise leave the join to the shuffle planner
  (sort-merge or shuffled hash, re-planned by AQE from measured sizes).
* ``null_aware_anti_join``: ``NOT IN`` without the forced broadcast. Spark
  plans ``x NOT IN (subquery)`` as a null-aware broadcast anti join even with
  broadcasting disabled, which cannot hold a large right side. Here the NULL
  rules are resolved by one scalar subquery over the list's distinct values
  and the join itself is an ordinary ``left_anti`` that may shuffle.
* ``small_side``: a side derived from a big table but expected small is
  written once to the shared checkpoint folder, counted, and broadcast, so
  the other (big) side is not shuffled.

The bounds are the session settings ``spark.fleetbook.broadcastRows`` and
``spark.fleetbook.broadcastBytes``. Where ``spark.sql.autoBroadcastJoinThreshold``
is -1 nothing but literal rows is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds of a broadcast side; dimension tables of the rental system (types,
# rates, offers, locations) are far below them.
ROWS_KEY, DEFAULT_BROADCAST_ROWS = "spark.fleetbook.broadcastRows", 2_000_000
BYTES_KEY, DEFAULT_BROADCAST_BYTES = "spark.fleetbook.broadcastBytes", 256 << 20

# Logical operators that keep rows where they are and make no new ones
_NARROW = {"Project", "Filter", "SubqueryAlias", "LocalRelation", "LogicalRelation", "LogicalRDD",
           "ResolvedHint"}
_STRING_BYTES = 64


def _limits(spark: SparkSession) -> tuple[int, int]:
    return (int(spark.conf.get(ROWS_KEY, str(DEFAULT_BROADCAST_ROWS))),
            int(spark.conf.get(BYTES_KEY, str(DEFAULT_BROADCAST_BYTES))))


def _auto_threshold(spark: SparkSession) -> int:
    """Spark's own broadcast threshold in bytes, -1 if broadcasting is off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _operators(df: DataFrame) -> set[str]:
    """Names of the nodes of the optimized plan."""
    names, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        names.add(node.nodeName())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return names


def row_bytes(schema: T.StructType) -> int:
    """Bytes of a row, text and nested values at a flat guess."""
    def width(t):
        if isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            return _STRING_BYTES
        return 16 if isinstance(t, T.DecimalType) else 8

    return 16 + sum(width(f.dataType) for f in schema.fields)


def _within(df: DataFrame, rows: int) -> bool:
    max_rows, max_bytes = _limits(df.sparkSession)
    return rows <= max_rows and rows * row_bytes(df.schema) <= max_bytes


def literal_rows(df: DataFrame) -> int | None:
    """An exact upper bound on the rows of a narrow plan over literal rows
    (``LocalRelation``): the leaf's own row count, which filters and
    projections can only reduce. None for any other plan."""
    if not _operators(df) <= _NARROW - {"LogicalRelation", "LogicalRDD"}:
        return None
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    count = leaves.apply(0).stats().rowCount()
    return int(str(count.get())) if count.isDefined() else None


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` is within the bounds: by the exact count of literal
    rows, else by counting (one partial row per task). Unless the rows are
    literal, never when broadcasting is off."""
    known = literal_rows(df)
    if known is not None:
        return _within(df, known)
    return _auto_threshold(df.sparkSession) >= 0 and _within(df, df.count())


def broadcast_counted(df: DataFrame) -> DataFrame:
    """``F.broadcast(df)`` if a count proves it within the bounds; for frames
    that are cheap to read again (cached, literal)."""
    return F.broadcast(df) if is_small(df) else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is proven to be within the bounds, else
    the unchanged ``df``.

    Only a narrow plan (no shuffle) is looked at: literal rows by their own
    count, files below Spark's own broadcast threshold as the planner would,
    files below the byte bound by a count. A side derived through a shuffle
    is left to the planner: AQE measures its shuffle output and converts the
    join to a broadcast at run time when it is small, so no plan is run twice
    just to size it.
    """
    if df.isStreaming:
        return df
    known = literal_rows(df)
    if known is not None:
        return F.broadcast(df) if _within(df, known) else df
    threshold = _auto_threshold(df.sparkSession)
    if threshold < 0 or not _operators(df) <= _NARROW:
        return df
    plan = df._jdf.queryExecution().optimizedPlan()
    estimate = int(str(plan.stats().sizeInBytes()))
    if estimate <= threshold:
        return F.broadcast(df)
    if estimate > _limits(df.sparkSession)[1]:
        return df
    return broadcast_counted(df)


def null_aware_anti_join(left: DataFrame, right: DataFrame,
                         left_key: str, right_key: str,
                         materialize_right: bool = True) -> DataFrame:
    """Rows of ``left`` whose ``left_key`` is ``NOT IN`` ``right.right_key``.

    Three-valued logic of ``x NOT IN (list)``:

    * empty list: every row qualifies, NULL ``x`` included;
    * list contains NULL: no row qualifies;
    * otherwise: rows with non-NULL ``x`` absent from the list.

    The list is reduced to its distinct values (a partial aggregate, NULL
    kept as one row) and, with ``materialize_right``, written once to the
    shared checkpoint folder and broadcast when proven small; so a list
    that is itself a join is computed once. Its state (holds a NULL /
    empty / plain) is one uncorrelated scalar subquery over those distinct
    values, referenced once, filtering the left rows below an ordinary anti
    join, so a list holding a NULL empties the left side before any
    shuffle. Spark's own plan for ``NOT IN`` would broadcast the whole list
    whatever its size.
    """
    distinct = right.select(F.col(right_key).alias("__nin_key")).distinct()
    distinct = small_side(distinct, materialize_right)
    keys = distinct.where(F.col("__nin_key").isNotNull())
    left_nullable = left.schema[left_key].nullable
    right_nullable = distinct.schema["__nin_key"].nullable
    if not (left_nullable or right_nullable):
        return left.join(keys, F.col(left_key) == F.col("__nin_key"), "left_anti")
    # 0 = holds a NULL, 1 = empty, 2 = non-empty without NULL
    n, nn = F.count(F.lit(1)), F.count("__nin_key")
    state = distinct.agg(F.when(n > nn, 0).when(n == 0, 1).otherwise(2).alias("s")).scalar()
    keep = F.element_at(F.array(F.lit(False), F.lit(True), F.col(left_key).isNotNull()),
                        state + 1)
    return left.where(keep).join(keys, F.col(left_key) == F.col("__nin_key"), "left_anti")


def small_side(df: DataFrame, enabled: bool = True) -> DataFrame:
    """For a side expected to be small but derived from a big table (a
    selective filter, a set of doomed keys): write it once as a table in the
    shared checkpoint folder, counting its rows in the same job, and
    broadcast it if it is within the bounds. The big side of the join is then
    scanned without a shuffle, which a sort-merge join re-planned by AQE at
    run time would already have paid for. If it is too large, the join reads
    a plain scan, so that AQE can split a hot key of the other side. Disabled
    (or streaming) it is returned as is."""
    from fleetbook.plans.materialize import write_counted

    if not enabled or df.isStreaming:
        return df
    written, rows = write_counted(df)
    small = _auto_threshold(df.sparkSession) >= 0 and _within(written, rows)
    return F.broadcast(written) if small else written


def distinct_side(df: DataFrame) -> DataFrame:
    """The distinct rows of a join's existence side. Where the planner can
    broadcast ``df`` by its size they are left to it. Otherwise they are
    written first, so that the join reads plain shuffles and AQE can split a
    hot key of the other side, which it cannot when this side is an
    aggregate."""
    threshold = _auto_threshold(df.sparkSession)
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.distinct() if 0 <= estimate <= threshold else small_side(df.distinct())
