"""Session helpers: one place for the Spark settings the library relies on.

On a cluster the session is built by the platform; the library only reads
from it. ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fleetbook") -> SparkSession:
    """A local session with the settings the tests assume.

    AQE stays on so joins whose small side turns out small at run time are
    converted to broadcasts from measured sizes, skewed partitions are split
    and empty shuffle partitions are coalesced.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(largest_shuffle_bytes: int, target_partition_bytes: int = 128 << 20,
                   cores: int | None = None) -> dict[str, str]:
    """Suggested settings for a job whose largest shuffle moves
    ``largest_shuffle_bytes``: enough shuffle partitions for ~128 MB each
    (AQE coalesces smaller stages), at least two waves of the cluster's
    cores, and AQE's skew split on. The caller decides whether to apply
    them; the library never overrides a cluster's settings."""
    parts = max(1, -(-largest_shuffle_bytes // target_partition_bytes))
    if cores:
        parts = max(parts, 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    is, and a cluster session without it is an error. Only a local session
    (tests, bench) without the setting gets a folder chosen here, registered
    with both the conf and the SparkContext.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # executors cannot share a folder on the driver's disk
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    base = fallback or tempfile.mkdtemp(prefix="fleetbook-ckpt-", dir="/tmp")
    spark.conf.set(CHECKPOINT_KEY, base)
    spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for derived tables,
    stream sinks and stream checkpoints."""
    root = _scope.get() or os.path.join(ensure_checkpoint_dir(spark), "fleetbook")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """One folder for all scratch tables written inside the block, removed at
    its end: for a job whose last write is done by then."""
    from fleetbook.sources.tables import delete_path

    root = scratch_path(spark, "job")
    token = _scope.set(root)
    try:
        yield root
    finally:
        _scope.reset(token)
        delete_path(spark, root)
