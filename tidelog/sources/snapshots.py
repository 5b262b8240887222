"""Snapshot exports: newline-delimited JSON files, one table and time each, named by convention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.events import json_field, nanos_to_millis
from tidelog.operators.filters import not_completed, only_tables
from tidelog.sources.exports import read_export
from tidelog.sources.folders import listing

#: 33 digits (date and time, nanoseconds, logical clock), node, number, table, part.
FILE_NAME = r"^(\d{33})-[^-]+-\d+-(.+)-[^-]+\.ndjson(?:\.gz)?$"


def file_table(name: Column) -> Column:
    """The table of a file name; null if it is not one of an export."""
    return F.nullif(F.regexp_extract(name, FILE_NAME, 2), F.lit(""))


def file_time(name: Column) -> Column:
    """The time of a file name in microseconds of Unix time; null if it has none."""
    digits = F.regexp_extract(name, FILE_NAME, 1)
    second = F.try_to_timestamp(F.concat(F.substring(digits, 1, 14), F.lit("Z")), F.lit("yyyyMMddHHmmssX"))
    return F.unix_micros(second) + F.substring(digits, 15, 6).try_cast("long")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank, with file_name, table and file_us. Files are read in parallel; a gzip file is one task."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ndjson*").text(path)
    # a file's lines are numbered by the start of its block and their place in the task that reads it
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    rows = lines.select(F.col("value"), F.col("_metadata.file_name").alias("file_name"), place.alias("place"))
    rows = rows.withColumn("table", file_table(F.col("file_name"))).withColumn("file_us", file_time(F.col("file_name")))
    return rows.where("table is not null and length(trim(value)) > 0")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Export files: file_name, table, file_us, length, empty files included. Contents are not read."""
    rows = listing(spark, path, "*.ndjson*").select("file_name", "length")
    return rows.withColumn("table", file_table(F.col("file_name"))).withColumn("file_us", file_time(F.col("file_name"))).where("table is not null")


def line_events(lines: DataFrame, versions: dict[str, str] | None = None) -> DataFrame:
    """Lines as insert events: key [id], time of the file, company before location. A line that is no JSON object is left
    out. Without an id the event's id is the hash of the line, so a repeated import makes the same events."""
    row = F.col("value")
    entity = F.coalesce(json_field(row, "id"), F.sha2(row, 256))
    version = F.lit(None).cast("string")
    if versions:
        known = F.create_map(*[F.lit(x) for kv in versions.items() for x in (kv[0].lower(), kv[1])])
        version = known[F.lower("table")]
    company = json_field(row, "companyId")
    return lines.where(F.schema_of_variant(F.try_parse_json(row)).startswith("OBJECT")).select(
        F.lit("INSERT").alias("operation"),
        F.sha2(F.concat_ws("|", "file_name", row), 256).alias("id"),
        "table",
        F.array(entity).alias("key"),
        version.alias("modelVersion"),
        company.alias("companyId"),
        F.coalesce(company, json_field(row, "locationId")).alias("locationId"),
        F.lit(None).cast("string").alias("userId"),
        F.lit(None).cast("string").alias("before"),
        row.alias("after"),
        F.lit(None).cast("array<string>").alias("diff"),
        F.floor(F.col("file_us") / 1000).alias("timestamp"),
        (F.col("file_us") * 1000).cast("string").alias("mvccTimestamp"),
        F.lit(True).alias("imported"),
        "file_name",
        *(["place"] if "place" in lines.columns else []),
    )


def broker_events(lines: DataFrame, at: Column | None = None) -> DataFrame:
    """Lines as a broker's import sends them: the event's id and key are the row's id if that is a JSON string, else the hash of the
    line (so a repeat is the same event), and its time is that of sending, or ``at`` in milliseconds. Lines that are no JSON
    objects are left out."""
    time = F.unix_millis(F.current_timestamp()) if at is None else at
    events, value = line_events(lines), F.col("after")
    is_text = F.schema_of_variant(F.variant_get(F.try_parse_json(value), "$.id", "variant")) == "STRING"
    own = F.coalesce(F.when(is_text, json_field(value, "id")), F.sha2(value, 256))
    return events.withColumns({"id": own, "key": F.array(own), "timestamp": time, "mvccTimestamp": F.lit(None).cast("string")})


def import_events(spark: SparkSession, path: str, known: list[str], only: list[str] | None = None, completed: DataFrame | None = None, versions: dict[str, str] | None = None, source: bool = True) -> DataFrame:
    """Events of an export: of known tables, of the listed ones if a list is given, without files already completed. Read by the data
    source of ``exports``, or, for stores that only Spark reaches, by Spark's reader (source=False)."""
    lines = only_tables(only_tables(read_export(spark, path) if source else read_lines(spark, path), known), only)
    if completed is not None:
        lines = not_completed(lines, completed)
    return line_events(lines, versions)


def import_counts(files: DataFrame, events: DataFrame) -> DataFrame:
    """Rows per table of the files, tables without a row included."""
    counts = events.groupBy("table").agg(F.count("*").alias("n"))
    return files.select("table").distinct().join(counts, "table", "left").select("table", F.coalesce("n", F.lit(0)).alias("n_rows"))


def cutoffs(files: DataFrame, cursor: str | None = None) -> DataFrame:
    """The time of the newest file of each table, in milliseconds: events up to it are in the snapshot. Where no file has a
    time, that of the export's cursor (nanoseconds of Unix time as text) counts, else now."""
    other = F.coalesce(nanos_to_millis(F.lit(cursor)), F.unix_millis(F.current_timestamp()))
    return files.groupBy("table").agg(F.coalesce(F.floor(F.max("file_us") / 1000), other).alias("cutoff_ms"))


def ordered_files(files: DataFrame) -> DataFrame:
    """Files by table and time, then name."""
    return files.orderBy("table", "file_us", "file_name")


def snapshot_mirror(events: DataFrame, base: DataFrame, schema) -> DataFrame:
    """The mirror of an imported table: of rows with one id the last line of the newest file stays, whole."""
    from tidelog.operators.mirror import apply_events

    place = ["place"] if "place" in events.columns else []
    newest = events.groupBy("key").agg(F.max_by(F.struct(*events.columns), F.struct("timestamp", "file_name", *place, "id")).alias("e"))
    return apply_events(base, newest.select("e.*").withColumn("seq", F.lit(0)), schema)
