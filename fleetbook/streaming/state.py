"""Streams with keyed state, and the replay of tables as streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# State kept on disk beside the executor, with changes alone written to the
# checkpoint after each batch (a snapshot from time to time, in the background)
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the block; a stream keeps those that it is started with."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_with_state(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a stream whose state is in RocksDB."""
    with settings(spark, ROCKSDB):
        return writer.start()


def finish(query: StreamingQuery) -> None:
    """Wait for a stream that stops by itself; its failure is raised here."""
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def write_time_slices(table: DataFrame, time: str, slices: int, path: str, flush_after: str | None = None,
                      flush_row: Mapping[str, object] | None = None) -> None:
    """Write ``table`` to a stream folder in ``slices`` time-ordered appends;
    rows without a time go to the last. With ``flush_after`` (an interval) a
    last file holds one row, NULL but for ``flush_row`` and a time that much
    after the newest, which moves the watermark past every row. An empty
    table gives an empty folder of its schema."""
    kind = table.schema[time].dataType
    lo, hi = table.agg(F.min(time), F.max(time)).first()
    if lo is None:
        table.write.mode("append").parquet(path)
        return
    step = (hi - lo) / slices
    for i in range(slices):
        cond = F.lit(True)
        if i > 0:
            cond = F.col(time) >= F.lit(lo + step * i).cast(kind)
        if i < slices - 1:
            cond = cond & (F.col(time) < F.lit(lo + step * (i + 1)).cast(kind))
        else:
            cond = cond | F.col(time).isNull()
        table.where(cond).write.mode("append").parquet(path)
    if flush_after is not None:
        values = {**(flush_row or {}), time: F.lit(hi) + F.expr(f"INTERVAL {flush_after}")}
        (table.sparkSession.range(1)
         .select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in table.schema.fields])
         .write.mode("append").parquet(path))
