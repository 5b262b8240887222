"""Tables that change in steps which readers see whole: numbered commits, and Parquet in versioned buckets that they point to."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.events import key_text
from tidelog.model import Schema


class Folder:
    """Small files on whatever file system Spark uses for a path."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        self._of = jvm.org.apache.hadoop.fs.Path
        self.fs = self._of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils

    def at(self, name: str):
        return self._of(f"{self.path}/{name}")

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file, which is there whole or not at all. One of that name that is there already stays, and is an error."""
        self.fs.mkdirs(self._of(self.path))
        part = self.at(f".part-{uuid.uuid4().hex}")
        stream = self.fs.create(part, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(part, self.at(name)):
            self.fs.delete(part, False)
            raise FileExistsError(f"{self.path}/{name}")

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._of(self.path))] if self.fs.exists(self._of(self.path)) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


class Ledger:
    """A JSON value that changes in numbered commits, each a file of its own that is renamed into place when it is whole and never
    touched again. The last one counts, so a driver that is lost at any moment, and any number of times, leaves the value before
    or the value after. A last commit that is no JSON object is an error, not an empty value. Of two writers with the same
    value in hand the second fails. A few commits stay for readers that hold an old one."""

    _NAME = re.compile(r"(\d{20})\.json")

    def __init__(self, spark: SparkSession, path: str, kept: int = 3):
        self.folder, self.kept = Folder(spark, path), kept

    def _numbers(self) -> list[int]:
        return sorted(int(m[1]) for n in self.folder.names() if (m := self._NAME.fullmatch(n)))

    def read(self) -> tuple[int, dict]:
        """The number of the last commit (-1 if there is none) and its value."""
        last = max(self._numbers(), default=-1)
        if last < 0:
            return -1, {}
        try:
            value = json.loads(self.folder.read(f"{last:020d}.json"))
        except ValueError as e:
            raise ValueError(f"{self.folder.path}: commit {last} is torn") from e
        if not isinstance(value, dict):
            raise ValueError(f"{self.folder.path}: commit {last} is torn")
        return last, value

    def commit(self, value: dict, after: int | None = None) -> int:
        """Make the commit that follows number ``after`` (the last one if not given)."""
        number = (self.read()[0] if after is None else after) + 1
        self.folder.create(f"{number:020d}.json", json.dumps(value))
        for n in self._numbers():
            if n <= number - self.kept:
                self.folder.remove(f"{n:020d}.json")
        for name in self.folder.names():
            if name.startswith(".part-"):
                self.folder.remove(name)
        return number


#: What a table that nothing was written to is like.
NEW = {"version": -1, "batch": -1, "at": {}, "stale": [], "shapes": {}, "shape": None, "next_id": 0, "keys": []}


def shape_of(schema: Schema) -> T.StructType:
    """Columns of a mirror, as the fold makes them: the key's, then the others."""
    names = [*schema.keys, *(n for n in schema.columns if n not in schema.keys)]
    return T.StructType([T.StructField(n, schema.properties[n].spark_type if n in schema.properties else T.StringType()) for n in names])


class Buckets:
    """Rows in buckets by the hash of their key, each in some version v=0, v=1, ... The state, a JSON value that the caller commits,
    tells which version of each bucket is in force; what is written shows only when a state that names it is committed.

    The state also has a log of the table's shapes. A column keeps its id through changes of its type and loses it when it is
    removed, so one that comes back by the same name is a new one. A bucket names the shape that it was written in and is projected
    to the shape in force when it is read: a new shape writes nothing. Without keys there is one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = (), buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), tuple(keys), buckets if keys else 1

    def bucket(self, key: Column) -> Column:
        """The bucket of a row's key as text (functions.events.key_text)."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _fields(state: dict, shape: str | None) -> dict[int, T.StructField]:
        """Columns of a shape by id."""
        return {c["id"]: T.StructField.fromJson(c["field"]) for c in state["shapes"][shape]} if shape is not None else {}

    def struct(self, state: dict) -> T.StructType | None:
        """The shape in force."""
        return T.StructType(list(self._fields(state, state["shape"]).values())) if state["shape"] is not None else None

    def reshaped(self, state: dict, to: T.StructType) -> dict:
        """The state with another shape in force; columns are the same if their names are, whatever the case."""
        if self.struct(state) == to:
            return state
        ids = {f.name.lower(): i for i, f in self._fields(state, state["shape"]).items()}
        free, columns = state["next_id"], []
        for f in to.fields:
            if f.name.lower() not in ids:
                ids[f.name.lower()], free = free, free + 1
            columns.append({"id": ids[f.name.lower()], "field": f.jsonValue()})
        name = str(1 + max(map(int, state["shapes"]), default=-1))
        used = {s for _, s in state["at"].values()}
        shapes = {k: v for k, v in state["shapes"].items() if k in used} | {name: columns}
        return state | {"shapes": shapes, "shape": name, "next_id": free}

    def rows(self, state: dict, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of some buckets, or of all, in the shape in force; None if there is none."""
        to = self._fields(state, state["shape"])
        if not to:
            return None
        by_shape: dict[str, list[str]] = {}
        for b, (v, shape) in state["at"].items():
            if buckets is None or int(b) in buckets:
                by_shape.setdefault(shape, []).append(f"{self.path}/{self._place(b, v)}")
        out = self.spark.createDataFrame([], T.StructType(list(to.values()))) if not by_shape else None
        for shape, paths in by_shape.items():
            there = self._fields(state, shape)
            rows = self.spark.read.schema(T.StructType(list(there.values()))).parquet(*paths)
            columns = []
            for i, f in to.items():
                value = F.col(f"`{there[i].name}`") if i in there else F.lit(None)
                columns.append((value if i in there and there[i].dataType == f.dataType else value.try_cast(f.dataType)).alias(f.name))
            rows = rows.select(*columns)
            out = rows if out is None else out.union(rows)
        return out

    @staticmethod
    def _place(bucket: str, version: int) -> str:
        return f"v={version}/_bucket={bucket}"

    def write(self, state: dict, df: DataFrame, buckets: list[int] | None = None) -> dict:
        """Write df as the next version of some buckets, or of all, in its own columns' shape; returns the state that has them."""
        state = self.reshaped(state, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))
        version = state["version"] + 1
        key = key_text([F.col(f"`{k}`") for k in self.keys]) if self.keys else F.lit("")
        rows = df.withColumn("_bucket", self.bucket(key)).hint("rebalance", "_bucket")
        rows.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/v={version}")
        written = [n.partition("=")[2] for n in Folder(self.spark, f"{self.path}/v={version}").names() if n.startswith("_bucket=")]
        new = {b: [version, state["shape"]] for b in written}
        at = {b: v for b, v in state["at"].items() if buckets is not None and int(b) not in buckets} | new
        return state | {"version": version, "at": at, "keys": list(self.keys)}

    def clean(self, before: dict, after: dict) -> None:
        """Remove what neither of two states that follow each other names, after the later one was committed."""
        for place in before["stale"]:
            Folder(self.spark, self.path).remove(place)
        self._remove_but({v for s in (before, after) for v, _ in s["at"].values()})

    def discard(self, state: dict) -> None:
        """Remove what an attempt after a state has left that was given up."""
        self._remove_but({v for v, _ in state["at"].values()} | {int(place[2:].partition("/")[0]) for place in state["stale"]})

    def _remove_but(self, versions: set[int]) -> None:
        folder = Folder(self.spark, self.path)
        for name in folder.names():
            if name.startswith("v=") and int(name[2:]) not in versions:
                folder.remove(name)

    @staticmethod
    def stale(before: dict, after: dict) -> list[str]:
        """Places that the state after replaces; they go when the next one is committed."""
        return [Buckets._place(b, v) for b, (v, _) in before["at"].items() if after["at"].get(b, [None])[0] != v]


class MirrorStore(Buckets):
    """Buckets with a state of their own ledger, or with one that is looked up where their owner keeps it."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = (), buckets: int = 64, state: Callable[[], dict] | None = None):
        super().__init__(spark, path, keys, buckets)
        self._ledger = Ledger(spark, f"{self.path}/_commits") if state is None else None
        self._state = state

    def state(self) -> dict:
        return NEW | (self._state() if self._ledger is None else self._ledger.read()[1])

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The committed rows of some buckets, or of all; None if there is no table yet."""
        return self.rows(self.state(), buckets)

    def commit(self, df: DataFrame, batch: int | None = None, buckets: list[int] | None = None) -> bool:
        """Write df as the next version of some buckets, or of all, and commit it. A batch that was committed before is not
        written again (returns False)."""
        now = self.state()
        if batch is not None and batch <= now["batch"]:
            return False
        new = self.write(now, df, buckets)
        self._ledger.commit(new | {"batch": now["batch"] if batch is None else batch, "stale": self.stale(now, new)})
        self.clean(now, new)
        return True


class KeyValues:
    """State of the engine: keys and values, replaced as a whole (Ledger). Prefixes are literal."""

    def __init__(self, spark: SparkSession, path: str):
        self._ledger = Ledger(spark, path)

    def all(self) -> dict[str, str]:
        return self._ledger.read()[1]

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.all().get(key, default)

    def _replace(self, change) -> None:
        number, now = self._ledger.read()
        self._ledger.commit(change(now), number)

    def set(self, values: dict[str, str]) -> None:
        self._replace(lambda now: now | values)

    def delete(self, *keys: str) -> None:
        self._replace(lambda now: {k: v for k, v in now.items() if k not in keys})

    def delete_prefix(self, prefix: str) -> None:
        self._replace(lambda now: {k: v for k, v in now.items() if not k.startswith(prefix)})
