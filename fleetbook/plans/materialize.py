"""Lineage cuts.

A result reused by several outputs (the due set of a settlement, the doomed
keys of a cascade) is written once to the shared checkpoint folder so that a
lost executor does not replay the whole upstream plan, and so that the
reused plan is not recomputed per consumer. The folder comes from the
session (``spark.checkpoint.dir``); nothing is kept on a machine-local disk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetbook.session import ensure_checkpoint_dir, scratch_path


def materialize(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Reliable, eager checkpoint of ``df``; a no-op when disabled or for a
    streaming frame."""
    if not enabled or df.isStreaming:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_counted(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """Write ``df`` as a parquet table in a fresh folder under the shared
    checkpoint folder and read it back, with its exact row count observed
    by the same job (no second pass to count it)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"fleetbook_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.parquet(path), int(obs.get["rows"])
