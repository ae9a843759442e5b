"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.plans.materialize import write_counted
from fleetbook.session import scratch_path


BROADCAST_IDS = 1_000_000  # ids of 8 bytes sent to every executor at most


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: the
    plan above is cut there, a lost executor re-reads files instead of
    recomputing, and the planner knows the table's real size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_ids(ids: DataFrame) -> DataFrame:
    """A table of one id column, written once; marked for broadcast when it
    has at most ``BROADCAST_IDS`` rows, else left to a shuffled join."""
    ids, n = write_counted(ids, "ids")
    return F.broadcast(ids) if n <= BROADCAST_IDS else ids


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one column), columns kept.
    A row with a null id stays."""
    gone = few_ids(ids.toDF("__gone_id").distinct())
    return docs.join(gone, docs[id_col] == gone["__gone_id"], "left_anti")


def text_batches(batches: Iterator[pa.RecordBatch], chunk_bytes: int
                 ) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches (last column: text) into runs of rows of about
    ``chunk_bytes`` of text, a null text read as empty. A longer text is a
    run of its own."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        sizes = [0 if n is None else n
                 for n in pc.binary_length(texts).to_pylist()]
        lo = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > chunk_bytes:
                yield batch.slice(lo, i - lo), _texts(texts.slice(lo, i - lo))
                lo, held = i, 0
            held += n
        if lo < batch.num_rows:
            yield batch.slice(lo), _texts(texts.slice(lo))


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept. ``lower`` does that for
    ASCII text; other text takes the slower per-character map."""
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, small))
