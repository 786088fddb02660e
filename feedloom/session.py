"""Session settings, and the one way this package cuts lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on. All can be set on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows sent to Python at a time; whole texts are among them, and batches wait on both sides
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS``; shuffle partitions and broadcast limit stay the cluster's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, shuffle_bytes: int, partition_bytes: int = 512 * 2**20) -> int:
    """Start shuffles of about ``shuffle_bytes`` with partitions of about ``partition_bytes``.

    Adaptive execution merges the small ones again, so a number that is too high costs little,
    and one that is too low spills.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    count = max(least, -(-shuffle_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(count))
    return count


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one if the driver is the
    only process, else an error."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        known = tempfile.mkdtemp(prefix="feedloom-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(known)
    return known


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from there; survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
