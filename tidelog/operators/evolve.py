"""Schema evolution: what changed between two versions, and a table in its new shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.model import Catalog, Schema


def schema_rows(spark: SparkSession, schema: Schema) -> DataFrame:
    """A schema as a table: name, type, format."""
    rows = [(n, p.type, p.format) for n, p in schema.properties.items()]
    return spark.createDataFrame(rows, "name string, type string, format string")


def new_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    return new.join(old, "name", "left_anti")


def removed_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.join(new, "name", "left_anti")


def changed_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns of both whose type or format differs: name, old_type, new_type, old_format, new_format."""
    o = old.select("name", F.col("type").alias("old_type"), F.col("format").alias("old_format"))
    both = new.select("name", F.col("type").alias("new_type"), F.col("format").alias("new_format")).join(o, "name")
    differs = ~F.col("old_type").eqNullSafe(F.col("new_type")) | ~F.col("old_format").eqNullSafe(F.col("new_format"))
    return both.where(differs).select("name", "old_type", "new_type", "old_format", "new_format")


def orphans(reflected: DataFrame, known: DataFrame, owned: DataFrame) -> DataFrame:
    """Tables that exist, that this engine made, and that no schema knows."""
    return reflected.join(known, "table", "left_anti").join(owned, "table", "left_semi")


def diff(old: Schema, new: Schema) -> dict[str, list[str]]:
    """Names of added, changed and removed columns, in the new (for removed: old) order."""
    o, n = old.properties, new.properties
    return {
        "added": [c for c in new.columns if c not in o],
        "changed": [c for c in new.columns if c in o and (o[c].type, o[c].format) != (n[c].type, n[c].format)],
        "removed": [c for c in old.columns if c not in n],
    }


def needs_migration(tracked: str | None, arrived: str) -> bool:
    """Versions that are numbers only go up; others migrate when they differ."""
    if tracked is None:
        return True
    if tracked.isdigit() and arrived.isdigit():
        return int(arrived) > int(tracked)
    return tracked != arrived


def reshape(mirror: DataFrame, schema: Schema, drop: bool = True) -> DataFrame:
    """The mirror in the schema's columns, order and types: new ones null, values that do not fit their new type null,
    removed ones gone (or, with drop=False, after the others)."""
    there = {c.lower(): c for c in mirror.columns}
    out = []
    for n in schema.columns:
        to = schema.properties[n].spark_type
        out.append((F.col(f"`{there[n.lower()]}`").try_cast(to) if n.lower() in there else F.lit(None).cast(to)).alias(n))
    if not drop:
        known = {n.lower() for n in schema.columns}
        out += [F.col(f"`{c}`") for c in mirror.columns if c.lower() not in known]
    return mirror.select(*out)


def add_missing(mirror: DataFrame, schema: Schema) -> DataFrame:
    """The mirror with the schema's columns that it lacks; nothing else changes."""
    there = {c.lower() for c in mirror.columns}
    return mirror.select("*", *[F.lit(None).cast(schema.properties[n].spark_type).alias(n) for n in schema.columns if n.lower() not in there])


def usable_columns(schema: Schema, there: list[str]) -> list[str]:
    """The schema's columns that the destination has."""
    known = {c.lower() for c in there}
    return [c for c in schema.columns if c.lower() in known]


def unknown_versions(events: DataFrame, catalog: Catalog) -> DataFrame:
    """Events of tables without a schema, to be parked until there is one."""
    return events.where(~F.lower("table").isin(list(catalog.keys()))) if catalog else events
