"""Where operators keep intermediate tables, and how they pass packed numbers between tasks."""

from __future__ import annotations

import atexit
import gc
import math
import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of one Arrow batch that goes to a Python worker.
BATCH_BYTES = 8 << 20
_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session under spark.checkpoint.dir, which all executors share. Only where driver and executors are one
    process, as in tests, a local folder stands in for it. It is removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not root:
            root = "file://" + tempfile.mkdtemp(prefix="tidelog-")
        _folders[app] = f"{root.rstrip('/')}/tidelog-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone already
        pass


def drop(df_path: str, spark: SparkSession) -> None:
    """Delete a table that keep() wrote and nothing reads any more."""
    _remove(spark, df_path)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: it is worked out once, survives lost executors
    and has no lineage."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete tables that keep() wrote and nothing reads any more, and have Spark drop the shuffle files of steps that are done,
    which it does when their plans are collected as garbage."""
    for path in paths:
        _remove(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def columns(df: DataFrame) -> list[str]:
    """The columns of df, quoted."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def by_place(df: DataFrame) -> DataFrame:
    """df with the names c0, c1, ... of its columns: mapInArrow takes no names with dots or backticks."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def map_rows(df: DataFrame, run, added: list[StructField]) -> DataFrame:
    """mapInArrow of a function that adds columns to all of df, whatever their names."""
    plain = by_place(df)
    return plain.mapInArrow(run, StructType([*plain.schema.fields, *added])).toDF(*df.columns, *[f.name for f in added])


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, unless the session has set its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(key))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def bucket_count(spark: SparkSession, items: int, per_bucket: int = 1 << 21) -> int:
    """Buckets such that one holds about per_bucket items at most; a power of two."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(items / per_bucket), 1)
    return 1 << (n - 1).bit_length()


def split_by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order of keys, and the buckets (top bits) present with the ends of their runs."""
    bits = buckets.bit_length() - 1
    order = np.argsort(keys, kind="stable")
    top = (keys[order] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    found, starts = np.unique(top, return_index=True)
    return order, found, np.append(starts, len(keys))


def by_key_blocks(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by the hash of keys and sort them, for a mapInArrow that reads runs of equal keys."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
