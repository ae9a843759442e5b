"""Tables bucketed and sorted by a join key, in Spark's catalogue.

Two tables with the same number of buckets on the same key join, and each is
grouped by the key, without an exchange: the shuffle is paid once, when the
copy is written. A hot key makes one bucket large, and a join of buckets
cannot be split at run time; ``read_bucketed`` therefore reads a table whose
largest bucket is far above the mean as plain files, which AQE can split.
"""

from __future__ import annotations

import re
import statistics

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.session import scratch_path
from fleetbook.sources.tables import _hadoop_path

SKEW = 4                # largest bucket against the mean
LEAST_SKEWED = 64 << 20  # bytes below which a bucket is no burden
BUCKET_BYTES = 256 << 20

_BUCKET = re.compile(r"_(\d+)(?:\.c\d+)?\.[^/]*parquet$")


def bucket_count(total_bytes: int, cores: int, target: int = BUCKET_BYTES) -> int:
    """Buckets of about ``target`` bytes, at least two per core, as a power of
    two so that tables of different sizes stay multiples of each other."""
    least = max(2 * cores, -(-total_bytes // target))
    return 1 << max(0, least - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> str:
    """Write ``df`` as catalogue table ``table`` in ``buckets`` buckets sorted
    by ``key``, one file a bucket (``repartition`` hashes keys as bucketing
    does), under ``path`` (a fresh shared folder by default). A table of that
    name is replaced, so a retry starts again. NULL keys share a bucket."""
    spark = df.sparkSession
    path = path or scratch_path(spark, table)
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return path


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket that has rows, from the file names."""
    p, fs = _hadoop_path(spark, path)
    sizes: dict[int, int] = {}
    for status in fs.listStatus(p):
        if m := _BUCKET.search(status.getPath().getName()):
            sizes[int(m[1])] = sizes.get(int(m[1]), 0) + status.getLen()
    return sizes


def read_bucketed(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The table by its buckets, or as plain files when one bucket holds far
    more than the others."""
    sizes = bucket_bytes(spark, path)
    worst = max(sizes.values(), default=0)
    if worst > LEAST_SKEWED and worst > SKEW * statistics.mean(sizes.values()):
        return spark.read.parquet(path)
    return spark.table(table)
