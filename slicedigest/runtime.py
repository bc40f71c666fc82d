"""What the jobs need from the running session: durable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROW_LIMIT = 500_000
BROADCAST_BYTE_LIMIT = 64 << 20
"""Most rows, and bytes as JSON text, that a plan-sized table may have to be broadcast; beyond either it is joined by shuffle."""


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taking the session's own setting first.

    Only a local master gets a folder of its own: on a cluster a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame that several jobs read to the checkpoint folder and return it with its lineage cut."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT, size: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Mark a materialised plan-sized frame for broadcast when it is proven small, else leave the join to Spark.

    Counts and measures at most ``limit + 1`` rows, so the check itself stays small.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    seen = df.limit(limit + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if seen["rows"] <= limit and seen["bytes"] <= size else df
