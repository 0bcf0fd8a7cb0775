"""Session settings the operators rely on, and small helpers around the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A row may be a cell of a few bytes or a message of some megabytes: batches are bounded by bytes, and by rows for cells.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "65536",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC) and what plans depend on (adaptive execution, size of Arrow batches)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def known(df: DataFrame, held: list[DataFrame]) -> tuple[DataFrame, int]:
    """``df`` computed and kept, with its number of rows; ``held`` receives what to unpersist.

    The planner then knows its size in bytes, and joins with it follow ``spark.sql.autoBroadcastJoinThreshold``. Meant for tables of keys.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(kept)
    return kept, kept.count()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh directory below the shared checkpoint folder the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="gridlake-")
    return f"{base.rstrip('/')}/gridlake-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch directory this job made, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
