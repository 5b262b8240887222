"""Which events and files take part: import windows, table lists, guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.events import MAX_NOTICE, is_identifier


def after_import(events: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Events that a snapshot does not contain yet: of tables without a cutoff (table, cutoff_ms) or later than it. Names of
    tables are compared exactly. There is one cutoff per table; Spark broadcasts them if they are small."""
    own = cutoffs.groupBy(F.col("table").alias("_t")).agg(F.max("cutoff_ms").alias("_cutoff"))
    joined = events.join(own, events["table"] == F.col("_t"), "left")
    return joined.where("_cutoff is null or timestamp > _cutoff").select(*events.columns)


def only_tables(df: DataFrame, tables: list[str] | None, column: str = "table") -> DataFrame:
    """Rows of the listed tables, whatever the case; None is all."""
    return df if tables is None else df.where(F.lower(column).isin([t.lower() for t in tables]))


def known_tables(df: DataFrame, tables: DataFrame, column: str = "table") -> DataFrame:
    """Rows whose table is in a one-column table of names, whatever the case."""
    names = tables.select(F.lower(tables.columns[0]).alias("_known")).distinct()
    return df.join(names, F.lower(df[column]) == F.col("_known"), "left_semi")


def not_completed(files: DataFrame, completed: DataFrame, column: str = "file_name") -> DataFrame:
    """Files whose base name is not among the completed ones, whatever the case."""
    base = lambda c: F.lower(F.regexp_extract(c, r"[^/\\]*$", 0))
    done = completed.select(base(F.col(completed.columns[0])).alias("_done")).distinct()
    return files.join(done, base(files[column]) == F.col("_done"), "left_anti")


def guarded(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events whose table is a safe identifier, and the others, which belong in the dead-letter table."""
    ok = F.coalesce(is_identifier("table"), F.lit(False))
    return events.where(ok), events.where(~ok)


def small_notices(df: DataFrame, column: str = "value", most: int = MAX_NOTICE) -> DataFrame:
    return df.where(F.octet_length(column) <= most)


def by_severity(alerts: DataFrame, severities: list[str], column: str = "severity") -> DataFrame:
    """Alerts of the listed severities, whatever the case; an empty list is all."""
    return alerts.where(F.lower(column).isin([s.lower() for s in severities])) if severities else alerts


def valid_rows(events: DataFrame, schema) -> DataFrame:
    """Events whose payload has every required column; deletes need none."""
    from tidelog.functions.events import any_of, fields, is_delete, payload

    needed = [n for n in schema.columns if schema.is_required(n)]
    if not needed:
        return events
    p = fields(payload(), needed)
    return events.where(is_delete() | ~any_of([p.getField(n).isNull() for n in needed]))
