"""Session builder and the shared scratch area of a job."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    # Hot join keys: split any shuffle partition that is far above the median, also
    # when the join output would otherwise have kept its partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # A scan is planned by its file size, but compressed columns grow in memory. What adaptive
    # execution has measured itself it may broadcast up to a higher bound, or hash without a sort.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # VARIANT columns are stored with their common members apart, and a scan reads the asked ones.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.allowReadingShredded": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

SHUFFLE_TARGET_BYTES = 256 * 1024**2


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions that keep a shuffle of this size near the target, at least one per core."""
    return max(cores, -(-shuffled_bytes // SHUFFLE_TARGET_BYTES))


def build_session(
    app: str = "ledgerloom",
    master: str | None = None,
    partitions: int | None = None,
    settings: dict[str, str] | None = None,
    shuffled_bytes: int | None = None,
    cores: int = 1,
) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``partitions`` is the shuffle width before adaptive coalescing. Without it, the width follows
    from ``shuffled_bytes``, the size of the largest shuffle to expect, and the cluster's ``cores``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = {**SETTINGS, **(settings or {})}
    if partitions is None and shuffled_bytes is not None:
        partitions = shuffle_partitions(shuffled_bytes, cores)
    if partitions:
        merged["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one written table, on storage that all executors share.

    The root is the session's ``spark.checkpoint.dir``. Only a local master may go without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{root.rstrip('/')}/ledgerloom/{label}-{uuid4().hex}"
