"""A Spark data source for snapshot exports: ``spark.read.format("tidelog_export").load(folder)``.

Files are found by their names, and filters on table, file_us and file_name choose among the names, so what they leave out is
never opened. Large files are read in splits, gzip files too, where they consist of several members (as made by appending, by
block compression, or by compressing in parallel): a split reads the members that begin in its range of bytes. It finds the first
by its magic bytes and proves it by decompressing it up to its checksum; from there on members follow each other. As with plain
files, a line belongs to the split in which it begins, wherever it ends. A file of one member is one task's. A task reads several
splits, of small files too, so that their number says how finely files are cut but not how many tasks there are.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

#: What a file's name says (sources.snapshots.FILE_NAME): time, table.
_NAME = re.compile(r"(\d{33})-[^-]+-\d+-(.+)-[^-]+\.ndjson(?:\.gz)?")
#: The beginning of a gzip member.
_MAGIC = b"\x1f\x8b\x08"
#: Bytes that are read from a file, and taken of a gzip member or after a split, and made, at a time; lines of a batch.
_BLOCK, _SOME, _MADE, _LINES = 1 << 20, 1 << 14, 4 << 20, 1 << 13
SPLIT_BYTES = 64 << 20
#: Bytes of a task, if splits are smaller; the number of tasks from which on they get more, up to SPLIT_BYTES; bytes that a file counts as at least.
_TASK, _TASKS, _FILE = 4 << 20, 1000, 1 << 18
SCHEMA = "file_name string, table string, file_us long, block long, line long, value string"
_COLUMNS = ["file_name", "table", "file_us", "block", "line", "value"]


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as Spark names it, and its path there."""
    for spark, arrow in (("s3a://", "s3://"), ("s3n://", "s3://"), ("file:/", "file:///")):
        if folder.startswith(spark):
            return pafs.FileSystem.from_uri(arrow + folder[len(spark) :].lstrip("/"))
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def parsed(name: str) -> tuple[str, int | None] | None:
    """The table and time (microseconds of Unix time; None if it is no time) of a file name; None if it is none of an export."""
    m = _NAME.fullmatch(name)
    if m is None:
        return None
    digits = m[1]
    try:
        second = datetime(int(digits[:4]), *(int(digits[k : k + 2]) for k in range(4, 14, 2)), tzinfo=timezone.utc)
    except ValueError:
        return m[2], None
    return m[2], int(second.timestamp()) * 1_000_000 + int(digits[14:20])


@dataclass
class Split:
    path: str
    name: str
    table: str
    file_us: int | None
    start: int
    end: int
    size: int


class Task(InputPartition):
    """What a task reads: ranges of files, each of whole splits that follow each other."""

    def __init__(self, ranges: list[Split]):
        super().__init__(None)
        self.ranges = ranges


def tasks(files: Iterable[Split], split: int) -> list[Task]:
    """Files dealt to tasks in their order. A task has several splits up to some size, or one that is larger; the driver holds ranges, not splits."""
    files = list(files)
    most = min(SPLIT_BYTES, max(_TASK, sum(f.size for f in files) // _TASKS))
    out, room = [], 0
    for f in files:
        at = 0
        while at < f.size:
            step = f.size - at if f.size - at <= room else room // split * split
            if step <= 0:
                out.append(Task([]))
                room = most
                step = min(f.size - at, max(split, most // split * split))
            out[-1].ranges.append(replace(f, start=at, end=at + step))
            room -= max(step, _FILE)
            at += step
    return out


def inflated(raw, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """What members from one on hold, piece by piece, with the place where the piece's member begins. A torn member or anything but
    zeros after one is an error, as for gzip."""
    raw.seek(at)
    data = b""
    while at < size:
        member = zlib.decompressobj(31)
        while not member.eof:
            data = data or raw.read(_SOME)
            if not data:
                raise EOFError(f"the gzip member at {at} is torn")
            out = member.decompress(data, _MADE)
            data = member.unconsumed_tail
            if out:
                yield at, out
        data = member.unused_data.lstrip(b"\0")
        while not data and (more := raw.read(_SOME)):
            data = more.lstrip(b"\0")
        at = raw.tell() - len(data)


def first_member(raw, start: int, end: int, size: int) -> int | None:
    """Where the first whole gzip member begins in a range of bytes."""
    at, tail = start, b""
    while at < end + 2:
        raw.seek(at)
        data = tail + raw.read(min(_BLOCK, end + 2 - at))
        base = at - len(tail)
        if len(data) <= len(tail):
            return None
        found = data.find(_MAGIC)
        while found >= 0:
            if base + found < end and _is_member(raw, base + found):
                return base + found
            found = data.find(_MAGIC, found + 1)
        at, tail = base + len(data), data[-2:]
    return None


def _is_member(raw, at: int) -> bool:
    raw.seek(at)
    member, data = zlib.decompressobj(31), b""
    try:
        while not member.eof:
            data = data or raw.read(_SOME)
            if not data:
                return False
            member.decompress(data, _MADE)
            data = member.unconsumed_tail
    except zlib.error:
        return False
    return True


def pieces(raw, split: Split) -> Iterator[tuple[bytes, bool]]:
    """The bytes of a split and of what follows it, each with whether it lies after the split. A plain file's split in which no line
    begins is not read further."""
    if not split.name.endswith(".gz"):
        at, begun = split.start, split.start == 0
        raw.seek(at)
        while at < split.size and (at < split.end or begun):
            data = raw.read(min(_BLOCK, split.end - at) if at < split.end else _SOME)
            if not data:
                return
            yield data, at >= split.end
            at += len(data)
            begun = begun or b"\n" in data
        return
    at = 0 if split.start == 0 else first_member(raw, split.start, split.end, split.size)
    if at is not None:
        for member, data in inflated(raw, at, split.size):
            yield data, member >= split.end


def lines(parts: Iterable[tuple[bytes, bool]], whole_first: bool) -> Iterator[bytes]:
    """The lines that begin in a split. The first one belongs to the split before, unless this is the first split; one that begins
    exactly where the split ends still belongs to it."""
    rest, skip, any_part = [], not whole_first, False
    for data, after in parts:
        any_part = True
        end = data.find(b"\n") + 1 if after else data.rfind(b"\n") + 1
        if not end:
            rest.append(data)
            continue
        full = b"".join([*rest, data[:end]])
        rest = [data[end:]]
        found = full.split(b"\n")[:-1]
        yield from found[1:] if skip else found
        skip = False
        if after:
            return
    if any_part and not skip and (last := b"".join(rest)):
        yield last


class ExportReader(DataSourceReader):
    def __init__(self, folder: str, split: int):
        self.folder, self.split, self.filters = folder, split, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on what a file's name says are done here; others are Spark's."""
        for f in filters:
            known = isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, IsNotNull, StringStartsWith))
            if known and f.attribute[0] in ("file_name", "table", "file_us"):
                self.filters.append(f)
            else:
                yield f

    def _chosen(self, facts: dict) -> bool:
        for f in self.filters:
            x = facts[f.attribute[0]]
            if x is None:
                return False
            if isinstance(f, EqualTo):
                ok = x == f.value
            elif isinstance(f, In):
                ok = x in f.value
            elif isinstance(f, GreaterThan):
                ok = x > f.value
            elif isinstance(f, GreaterThanOrEqual):
                ok = x >= f.value
            elif isinstance(f, LessThan):
                ok = x < f.value
            elif isinstance(f, LessThanOrEqual):
                ok = x <= f.value
            elif isinstance(f, StringStartsWith):
                ok = x.startswith(f.value)
            else:
                ok = True
            if not ok:
                return False
        return True

    def partitions(self) -> list[Task]:
        """Tasks for the files whose names are chosen; an empty file is in none."""
        fs, root = opened(self.folder)
        files = []
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            said = parsed(info.base_name) if info.is_file else None
            if said and info.size and self._chosen({"file_name": info.base_name, "table": said[0], "file_us": said[1]}):
                files.append(Split(info.path, info.base_name, *said, 0, info.size, info.size))
        return tasks(sorted(files, key=lambda f: f.path), self.split) or [Task([])]

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.folder)
        for part in partition.ranges:
            held = []
            with io.BufferedReader(fs.open_input_file(part.path), _BLOCK) as raw:
                for at in range(part.start, part.end, self.split):
                    split = replace(part, start=at, end=min(at + self.split, part.end))
                    for n, line in enumerate(lines(pieces(raw, split), at == 0)):
                        held.append((at, n, line.removesuffix(b"\r").decode("utf-8", "replace")))
                        if len(held) == _LINES:
                            yield self._batch(part, held)
                            held = []
            if held:
                yield self._batch(part, held)

    @staticmethod
    def _batch(part: Split, held: list[tuple[int, int, str]]) -> pa.RecordBatch:
        same = [pa.repeat(pa.scalar(x, t), len(held)) for x, t in ((part.name, pa.string()), (part.table, pa.string()), (part.file_us, pa.int64()))]
        own = [pa.array([x[k] for x in held], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays([*same, *own], _COLUMNS)


class ExportSource(DataSource):
    """Options: path, and splitBytes, the bytes of a file's splits, of which a task reads one or more."""

    @classmethod
    def name(cls) -> str:
        return "tidelog_export"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ExportReader:
        return ExportReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_export(spark: SparkSession, path: str, split: int = SPLIT_BYTES, tables: list[str] | None = None) -> DataFrame:
    """Lines of an export that are not blank: file_name, table, file_us, value, and place, which orders a file's lines. Of the listed
    tables, if there is a list, as they are written in the names. Folders are those that pyarrow reaches (local, mounted, S3,
    HDFS, Google)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ExportSource)
    rows = spark.read.format("tidelog_export").option("splitBytes", split).load(path)
    if tables is not None:
        rows = rows.where(F.col("table").isin(tables))
    return rows.where("length(trim(value)) > 0").select("value", "file_name", F.struct("block", "line").alias("place"), "table", "file_us")
