"""A Spark data source that writes an object per event: ``events.write.format("tidelog_objects").option("path", folder)``.

Names are exact (prefix/table/time-id.json), so a repeat replaces what it wrote before. A task first writes all its objects below
a folder of its own that readers don't look into, and gives them their names when the last is whole; a task that fails half way
leaves none. What a lost task leaves in its folder goes when the job ends, whichever way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidelog.functions.events import event_json, object_path
from tidelog.sources.exports import opened

SCHEMA = "path string, body string"


@dataclass
class Written(WriterCommitMessage):
    objects: int
    bytes: int


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder, f"_part-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.folder)
        own, names, size = f"{root}/{self.job}/{uuid.uuid4().hex}", {}, 0
        fs.create_dir(own, recursive=True)
        for batch in iterator:
            for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = body.encode()
                place = names.setdefault(path, f"{own}/{len(names)}")
                with fs.open_output_stream(place, compression=None) as out:
                    out.write(data)
                size += len(data)
        made: set[str] = set()
        for path, place in names.items():
            whole = f"{root}/{path}"
            parent = whole.rpartition("/")[0]
            if parent not in made:
                fs.create_dir(parent, recursive=True)
                made.add(parent)
            fs.move(place, whole)
        fs.delete_dir(own)
        return Written(len(names), size)

    def _clear(self) -> None:
        fs, root = opened(self.folder)
        if fs.get_file_info(f"{root}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.job}")

    def commit(self, messages: list[Written | None]) -> None:
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()


class ObjectSink(DataSource):
    """Takes rows of path and body. Option: path, the folder or bucket."""

    @classmethod
    def name(cls) -> str:
        return "tidelog_objects"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options["path"])


def write_objects(events: DataFrame, folder: str, prefix: str | None = None) -> None:
    """One JSON object per event at prefix/table/timestamp-id.json, replaced if it is there. Of events with one name in a task the last
    counts. ``folder`` is any location that pyarrow reaches (local, s3:// and s3a://, gs://, hdfs://, abfss://)."""
    events.sparkSession.dataSource.register(ObjectSink)
    rows = events.select(object_path(prefix).alias("path"), event_json(events.columns).alias("body"))
    rows.write.format("tidelog_objects").option("path", folder).mode("append").save()
