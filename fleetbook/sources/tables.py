"""Reading and appending tables.

Every table is one parquet dataset ``<dir>/<name>.parquet``. Reads are lazy;
Catalyst prunes columns and pushes filters into the scan, so callers select
only what they need and never pre-read whole tables.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetbook.sources.schemas import SCHEMAS

# The driver's test tables.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


# Column types of the driver's star-schema tables. Declaring
# them spares the footer read that schema inference needs on every read.
STAR_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Lazy parquet read. With a schema no inference pass is made."""
    reader = spark.read
    if schema is None and name in SCHEMAS:
        schema = SCHEMAS[name]
    if schema is None and name in STAR_SCHEMAS:
        schema = T._parse_datatype_string(STAR_SCHEMAS[name])
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(base_dir, name))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system that Spark reads it from."""
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of derived data and all it holds."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def stream_table(spark: SparkSession, base_dir: str, name: str,
                 max_files: int = 1000) -> DataFrame:
    """The table as a stream of its files, at most ``max_files`` a
    micro-batch. A table that is a folder of part files is the source
    folder itself; a table that is one file is picked out of its folder."""
    schema = read_table(spark, base_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    p, fs = _hadoop_path(spark, table_path(base_dir, name))
    if fs.getFileStatus(p).isDirectory():
        return reader.parquet(table_path(base_dir, name))
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(base_dir)


def scan_all(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``select * from t``."""
    return read_table(spark, base_dir, name)


def rows_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Literal rows as a DataFrame of the given schema (``INSERT ... VALUES``).

    The rows go through Arrow into a ``LocalRelation``, which carries an
    exact row count in its statistics, so the planner (and
    ``bounded_broadcast``) know its size without running a job.
    """
    import pandas as pd

    data = pd.DataFrame([list(r) for r in rows], columns=schema.fieldNames(), dtype=object)
    return spark.createDataFrame(data, schema)


def append_rows(df: DataFrame, rows: Iterable[Sequence] | DataFrame) -> DataFrame:
    """Multi-row append: the table plus new rows, matched by column name.

    ``rows`` may be literal tuples in the table's column order or a DataFrame.
    The result is lazy; ``write_table(..., mode="append")`` persists it.
    """
    if not isinstance(rows, DataFrame):
        rows = rows_frame(df.sparkSession, rows, df.schema)
    return df.unionByName(rows)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Persist a table. Append adds new files only, so a failed job leaves
    the committed files untouched (Spark's commit protocol)."""
    df.write.mode(mode).parquet(path)
