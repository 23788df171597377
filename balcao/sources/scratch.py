"""Intermediate tables in the folder that all executors share.

Where a result is read more than once, or two readers must see the very same
partitioning, it is written as a table and read back. Lost executors then cost a
re-read of files, not a recomputation that may come out differently.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` if the cluster names one, else a local folder.

    The fallback only serves sessions in one process, where driver and executors
    see the same disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return f"{named.rstrip('/')}/balcao-{context.applicationId}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="balcao-")
    return _LOCAL[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a reader of what was written."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
