"""A table's maximum from the statistics in its parquet footers.

Spark's V2 parquet reader answers an ungrouped ``max`` from the row groups'
statistics without reading rows (``spark.sql.parquet.aggregatePushdown``).
The maximum is then a filter that statistics prune, so only the row groups
that may hold it are read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_max(spark: SparkSession, path: str, schema: T.StructType, column: str) -> DataFrame:
    """One row, ``m``: the column's maximum, NULLs aside, as a plan that reads
    footers. It belongs to a session of its own with the two settings that it
    needs, so those of ``spark`` stay as they are."""
    own = spark.newSession()
    for k, v in FOOTERS.items():
        own.conf.set(k, v)
    return own.read.schema(schema).parquet(path).agg(F.max(column).alias("m"))


def column_max(spark: SparkSession, path: str, schema: T.StructType, column: str):
    """The column's maximum, or None without a value. Files without statistics
    for the column (a NaN or nothing but NULLs is enough) make the reader
    refuse; the table is then scanned."""
    try:
        return footer_max(spark, path, schema, column).first()[0]
    except (PySparkException, Py4JJavaError) as e:
        if "min/max" not in str(e):
            raise
        return spark.read.schema(schema).parquet(path).agg(F.max(column)).first()[0]


def rows_at_maximum(spark: SparkSession, path: str, schema: T.StructType, column: str,
                    amount: T.DecimalType = T.DecimalType(12, 2)) -> DataFrame:
    """All rows whose ``column``, as an amount, is at the maximum; ties are
    kept and NULLs are not at it. The filter on the raw column reaches the
    reader; the margin below the maximum covers values that round to it."""
    table, top = spark.read.schema(schema).parquet(path), column_max(spark, path, schema, column)
    if top is None:
        return table.limit(0)
    rounded = F.col(column).cast(amount)
    margin = 10 ** -amount.scale if isinstance(schema[column].dataType, (T.FloatType, T.DoubleType)) else 0
    return table.where(F.col(column) >= F.lit(top - margin)).where(rounded == F.lit(top).cast(amount))
