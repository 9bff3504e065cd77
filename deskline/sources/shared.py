"""Where a job may write tables that all executors can read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` or, where that is not set, under the
    session's warehouse, which its file system holds on every deployment."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
