"""Files below a path, as a table."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.exports import opened

_FILE = "path string, file_name string, length long"


def _facts(infos: list[pafs.FileInfo], glob: str) -> list[tuple[str, str, int]]:
    return [(i.path, i.base_name, i.size) for i in infos if i.is_file and fnmatchcase(i.base_name, glob)]


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, file_name and length of all files below path whose name matches, empty ones included. The driver lists the first level;
    each folder in it is listed, with all below, by a task, so that file names don't pass through the driver."""
    fs, root = opened(path)
    first = fs.get_file_info(pafs.FileSelector(root))
    folders = [(i.path,) for i in first if i.type == pafs.FileType.Directory]
    scheme = path.partition("://")[0] + "://" if "://" in path else "file://"
    files = spark.createDataFrame(_facts(first, glob), _FILE)
    if folders:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            there, _ = opened(path)
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    found = _facts(there.get_file_info(pafs.FileSelector(folder, recursive=True)), glob)
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["path", "file_name", "length"])

        below = spark.createDataFrame(folders, "folder string").repartition(min(len(folders), 4 * spark.sparkContext.defaultParallelism), "folder")
        files = files.unionByName(below.mapInArrow(run, _FILE))
    return files.withColumn("path", F.concat(F.lit(scheme), "path"))
