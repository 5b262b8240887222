"""Change events from files and brokers, batch and streaming."""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.model import EVENT
from tidelog.sources.msgpack import msgpack_text

#: before and after are objects on the wire and text in the engine; from_json keeps nested values of string fields as text.
_WIRE = T.StructType([*EVENT.fields, T.StructField("_corrupt_record", T.StringType())])


@F.pandas_udf(T.StringType())
def gunzip(values: pd.Series) -> pd.Series:
    def one(x: bytes | None) -> str | None:
        try:
            return None if x is None else (gzip.decompress(x) if x[:2] == b"\x1f\x8b" else bytes(x)).decode()
        except (OSError, EOFError, UnicodeDecodeError, zlib.error):
            return None

    return values.map(one)


@F.pandas_udf(T.BinaryType())
def inflate(values: pd.Series) -> pd.Series:
    """Bytes without gzip, if they have it; null if it is broken."""

    def one(x: bytes | None) -> bytes | None:
        try:
            return None if x is None else gzip.decompress(x) if x[:2] == b"\x1f\x8b" else bytes(x)
        except (OSError, EOFError, zlib.error):
            return None

    return values.map(one)


def decode(messages: DataFrame, value: str = "value", compressed: bool = False, packed: Column | bool = False) -> tuple[DataFrame, DataFrame]:
    """Events, and the messages that are none (with ``error``), from JSON text or bytes, or from MessagePack where ``packed`` says so (a
    condition such as on a header's content type).

    A message is an event if it parses and has an operation, an id and a table. A column ``arrival`` of messages stays with
    their events.
    """
    text = gunzip(F.col(value)) if compressed else F.col(value).cast("string")
    if packed is not False:
        body = inflate(F.col(value)) if compressed else F.col(value)
        text = msgpack_text(body) if packed is True else F.when(packed, msgpack_text(body)).otherwise(text)
    rows = messages.withColumn("_text", text).withColumn("_e", F.from_json("_text", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad: Column = F.col("_e").isNull() | F.col("_e._corrupt_record").isNotNull()
    for needed in ("operation", "id", "table"):
        bad = bad | F.col(f"_e.{needed}").isNull()
    place = ["arrival"] if "arrival" in messages.columns else []
    events = rows.where(~bad).select("_e.*", *place).drop("_corrupt_record").withColumn("timestamp", F.coalesce("timestamp", F.lit(0)))
    return events, rows.where(bad).select(F.coalesce("_text", F.lit("")).alias("payload"), F.lit("not a change event").alias("error"))


def read_events(spark: SparkSession, path: str, glob: str = "*.json*") -> DataFrame:
    """Events from JSON lines, plain or gzip, under a path."""
    return decode(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path))[0]


def stream_events(spark: SparkSession, path: str, max_files: int = 100, latest_first: bool = False) -> DataFrame:
    """A stream of messages from files, with the file's time, its name and the place of a block in it, which come before the
    line as the place of arrival. max_files bounds a micro-batch."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").option("latestFirst", str(latest_first).lower())
    m = F.col("_metadata")
    block = F.struct(m.file_modification_time.alias("at"), m.file_path.alias("of"), m.file_block_start.alias("block"))
    return reader.text(path).select("value", block.alias("block"))


def with_arrival(messages: DataFrame) -> DataFrame:
    """Messages of a batch with ``arrival``, which orders them: a broker's offset and partition, or the file and block that a
    stream of files names, then the place in the batch."""
    known = next((x for x in (["offset", "partition"], ["block"]) if set(x) <= set(messages.columns)), [])
    return messages.withColumn("arrival", F.struct(*known, F.monotonically_increasing_id().alias("line")))


def kafka_options(servers: str, topic: str, new_only: bool = False, most: int = 16_384) -> dict[str, str]:
    """Options of the Kafka source: start position and events per micro-batch (the connector is not bundled)."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest" if new_only else "earliest", "maxOffsetsPerTrigger": str(most)}


def subjects(companies: list[str] | None) -> list[str]:
    """Subjects of a consumer of some companies' events, or of all."""
    return [f"dbchange.*.*.{c}.*.PUBLIC.>" for c in companies] if companies else ["dbchange.>"]


def numbered(batch: DataFrame, order: list[str], staging: str, base: int = 0) -> DataFrame:
    """The batch with ``seq``: dense numbers from base + 1 on, in order.

    Rows are dealt out in ranges of the order, sorted, and written with their range and place to ``staging``; numbers of rows per
    range are added up and joined. Writing first matters: the ranges come from a sample, so working them out twice could cut
    them differently. What reaches the driver is a row per range.
    """
    spark = batch.sparkSession
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    ranged = batch.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_part", F.spark_partition_id()).withColumn("_i", place).write.mode("overwrite").parquet(staging)
    rows = spark.read.parquet(staging)
    at, bases = base + 1, []
    for part, n in sorted(map(tuple, rows.groupBy("_part").count().collect())):
        bases.append((part, at))
        at += n
    offsets = spark.createDataFrame(bases, "_part int, _base long")
    return rows.join(F.broadcast(offsets), "_part").select(*batch.columns, (F.col("_base") + F.col("_i")).alias("seq"))
