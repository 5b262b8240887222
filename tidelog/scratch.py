"""A folder that driver and executors share, for what a job writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; below a local one only where driver and executors are one process, as in tests."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or 'file://' + tempfile.mkdtemp(prefix='tidelog-')).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
