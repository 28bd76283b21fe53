"""Folders for tables that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder, for one use, in the one that all executors share: ``spark.checkpoint.dir``. Where that is unset and all
    runs in one process, as in tests, it is in a temporary folder; a cluster has to set it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="skytally-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
