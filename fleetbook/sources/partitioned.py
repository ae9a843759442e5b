"""Tables partitioned by month or by load: pruned reads, re-runnable appends,
and updates that rewrite only the partitions they change.

A month is a whole number (199601), so that Spark reads the folder names
back as integers and compares them in order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook.sources.tables import _hadoop_path, delete_path, path_exists

NO_MONTH = 0          # rows without a date
LOAD = "load_id"
_PENDING, _COMPLETE = "_pending", "_COMPLETE"


# ----------------------------------------------------------------------- months

def month_of(date: Column | str) -> Column:
    """The month of a date as a number; ``NO_MONTH`` without a date."""
    d = F.col(date) if isinstance(date, str) else date
    return F.coalesce(F.year(d) * 100 + F.month(d), F.lit(NO_MONTH))


def write_by_month(df: DataFrame, path: str, date: str, month: str) -> None:
    """Write ``df`` with a folder per month of ``date``. Rows of a month are
    brought together first, so that a month is few files; a month with most
    of the rows is spread over several tasks by AQE."""
    df.withColumn(month, month_of(date)).hint("rebalance", F.col(month)).write.mode("overwrite").partitionBy(
        month).parquet(path)


def between_months(table: DataFrame, month: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """The rows of the months of ``lo`` to ``hi``, both included: a filter on
    folders, so other months are not read. Rows without a date are left out."""
    rows = table.where(F.col(month) > NO_MONTH)
    if lo is not None:
        rows = rows.where(F.col(month) >= lo.year * 100 + lo.month)
    if hi is not None:
        rows = rows.where(F.col(month) <= hi.year * 100 + hi.month)
    return rows


# ------------------------------------------------------ rewriting what changed

def replace_partitions(df: DataFrame, path: str, part: str | None) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows of; the others
    keep their files.

    The new rows are first written beside the table and marked complete; only
    then are the table's partitions replaced. If the job dies before the
    mark, the table is untouched; if it dies after, ``recover`` (called here
    and by ``update_partitions``) replaces them again from the complete copy.
    """
    spark, pending = df.sparkSession, path.rstrip("/") + _PENDING
    recover(spark, path, part)
    writer = df.write.mode("overwrite")
    (writer if part is None else writer.partitionBy(part)).parquet(pending)
    mark, fs = _hadoop_path(spark, f"{pending}/{_COMPLETE}")
    fs.create(mark).close()
    recover(spark, path, part)


def replace_table(df: DataFrame, path: str) -> None:
    """``replace_partitions`` for a table without partitions."""
    replace_partitions(df, path, None)


def recover(spark: SparkSession, path: str, part: str | None) -> None:
    """Finish or undo a replacement that was cut short."""
    pending = path.rstrip("/") + _PENDING
    if not path_exists(spark, pending):
        return
    if path_exists(spark, f"{pending}/{_COMPLETE}"):
        writer = spark.read.parquet(pending).write.mode("overwrite")
        if part is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(part)
        writer.parquet(path)
    delete_path(spark, pending)


def update_partitions(spark: SparkSession, path: str, part: str, changed: Callable[[DataFrame], DataFrame],
                      update: Callable[[DataFrame], DataFrame]) -> list:
    """Update a partitioned table in place: ``changed`` gives rows of the table
    that will change (its ``part`` column is used), ``update`` the new version
    of any set of whole partitions. Only partitions with a changed row are
    read again and written. Returns them; they come to the driver as the
    list of folders, never more than the table has."""
    recover(spark, path, part)
    table = spark.read.parquet(path)
    touched = sorted(r[0] for r in changed(table).select(part).distinct().collect())
    if touched:
        replace_partitions(update(table.where(F.col(part).isin(touched))), path, part)
    return touched


def delete_from_partitions(spark: SparkSession, path: str, part: str, doomed: Callable[[DataFrame], DataFrame],
                           keep: Callable[[DataFrame], DataFrame]) -> list:
    """``update_partitions`` for a delete: partitions that lose all their rows
    are removed as folders, since nothing replaces them."""
    touched = update_partitions(spark, path, part, doomed, keep)
    if touched:
        left = {r[0] for r in doomed(spark.read.parquet(path)).select(part).distinct().collect()}
        for value in left:
            delete_path(spark, f"{path}/{part}={value}")
    return touched


# ------------------------------------------------------------------------ loads

def append_load(df: DataFrame, path: str, load: str) -> None:
    """Append ``df`` as load ``load``. Loading it again replaces its own rows,
    so a retried append does not double them; a load that has become empty is
    removed. Other loads are untouched."""
    if not load or "/" in load:
        raise ValueError(f"load: {load!r}")
    spark, seen = df.sparkSession, Observation()
    (df.withColumn(LOAD, F.lit(load)).observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path))
    if not seen.get["rows"]:
        delete_path(spark, f"{path}/{LOAD}={load}")


def read_loads(spark: SparkSession, path: str, schema: T.StructType, loads: Iterable[str] | None = None) -> DataFrame:
    """The rows of all loads, or of some, as one table."""
    fields = [f for f in schema.fields if f.name != LOAD]
    table = spark.read.schema(T.StructType([*fields, T.StructField(LOAD, T.StringType())])).parquet(path)
    if loads is not None:
        table = table.where(F.col(LOAD).isin(list(loads)))
    return table.drop(LOAD)
