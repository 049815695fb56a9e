"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for big runs. AQE splits skewed join sides and merges small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.fieldId.write.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # a batch for a Python worker ends at whichever comes first, so huge geometries cannot fill its memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(name: str = "geoloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir`` or the context's checkpoint folder.

    Only where both are unset and everything runs in one process (a local test session) a temporary folder is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = getattr(spark, "_geoloom_local_dir", None)
    if local is None:
        local = tempfile.mkdtemp(prefix="geoloom-")
        spark._geoloom_local_dir = local
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """``checkpoint()`` to the shared folder, so that lost executors cannot change the rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
