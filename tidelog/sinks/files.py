"""Events to files and object stores, dead letters, raw copies."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.events import dead_letter, log_row
from tidelog.sources.exports import opened
from tidelog.sources.folders import listing


def append_log(events: DataFrame, path: str, seq: str = "seq", mode: str = "append") -> None:
    """Append events to a log, partitioned by table; with mode overwrite, replace what a batch of its own path holds."""
    rows = events.select(F.col(seq).alias("_seq"), *log_row(), F.col("table").alias("table"))
    rows.write.mode(mode).partitionBy("table").parquet(path)


def write_json(events: DataFrame, path: str) -> None:
    """Events as JSON lines, a folder per table: few large files, as object stores like them."""
    events.withColumn("_t", F.col("table")).withColumnRenamed("_t", "folder").write.mode("append").partitionBy("folder").json(path)


def write_dead_letters(events: DataFrame, path: str, error: str | Column, retries: int = 0, mode: str = "append") -> None:
    error = F.lit(error) if isinstance(error, str) else error
    events.select(*dead_letter(error, F.lit(retries))).write.mode(mode).parquet(path)


def dry_run(events: DataFrame) -> None:
    """Work everything out and write nothing."""
    events.write.format("noop").mode("overwrite").save()


def copy_files(spark: SparkSession, source: str, target: str, glob: str = "*") -> DataFrame:
    """Copy files as they are, below their names; returns file_name and length. Executors copy with pyarrow's file systems;
    no file goes through the driver."""
    files = listing(spark, source, glob).select("path", "length")
    files = files.repartition(max(1, min(files.count(), spark.sparkContext.defaultParallelism)))

    def copy(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs as pafs

        (here, _), (to, root) = opened(source), opened(target)
        to.create_dir(root, recursive=True)
        for batch in batches:
            names = []
            for path in batch.column(0).to_pylist():
                names.append(path.rpartition("/")[2])
                pafs.copy_files(path.partition("://")[2], f"{root}/{names[-1]}", source_filesystem=here, destination_filesystem=to)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column(1)], ["file_name", "length"])

    return files.mapInArrow(copy, "file_name string, length long")
