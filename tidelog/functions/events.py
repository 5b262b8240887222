"""Column expressions over change events. None of them is a UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What names, numbers, message keys ("dbchange") and error lengths must look like for other readers.
IDENTIFIER = r"^[A-Za-z0-9_]{1,128}$"
NUMBER = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MAX_ERROR = 2000
MAX_NOTICE = 1 << 20


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_delete(operation="operation") -> Column:
    return F.lower(c(operation)) == "delete"


def is_update(operation="operation") -> Column:
    return F.lower(c(operation)) == "update"


def payload(after="after", before="before") -> Column:
    """The row after the change, else before it."""
    return F.coalesce(c(after), c(before))


def json_field(json: str | Column, name: str) -> Column:
    """A field as text: null for JSON null, JSON text for nested values. Dots and brackets in names do no harm."""
    if "'" not in name:
        return F.get_json_object(c(json), f"$['{name}']")
    return fields(json, [name])[name]


def fields(json: str | Column, names: list[str]) -> Column:
    """A struct of fields as text, for which the JSON is parsed once."""
    return F.from_json(c(json), T.StructType([T.StructField(n, T.StringType()) for n in names]))


def entity_id(key="key", after="after", before="before") -> Column:
    """The last key segment; without any, the payload's id if it is a JSON string; else ''."""
    whole = payload(after, before)
    raw = F.get_json_object(whole, "$.id")
    # get_json_object unquotes strings, so a string is what is not the same text as a JSON value of another type
    is_text = F.schema_of_variant(F.variant_get(F.try_parse_json(whole), "$.id", "variant")) == "STRING"
    return F.when(F.size(c(key)) >= 1, F.element_at(c(key), -1)).otherwise(F.coalesce(F.when(is_text, raw), F.lit("")))


def delete_key(position: int = 0, key="key", of: int = 1) -> Column:
    """The key value that a delete matches with the primary key at ``position`` of ``of``: the segment after it, '' if there is
    none; as many segments as the key has columns are the key itself."""
    k = c(key)
    return F.coalesce(F.when(F.size(k) == of, F.get(k, F.lit(position))).otherwise(F.get(k, F.lit(position + 1))), F.lit(""))


def row_key(names: tuple[str, ...] | list[str]) -> Column:
    """What identifies the row that an event changes, as text: the key of one column as it is, of several a JSON array.

    Deletes match by the segments of their key (delete_key), other events by the payload's columns, else by the segments
    from the end. Null if a column of several is null.
    """
    if len(names) == 1:
        return F.when(is_delete(), delete_key(0)).otherwise(entity_id())
    own = fields(payload(), list(names))
    parts = [
        F.when(is_delete(), delete_key(i, of=len(names))).otherwise(F.coalesce(own.getField(n), F.get("key", F.size("key") - len(names) + i)))
        for i, n in enumerate(names)
    ]
    return key_text(parts)


def key_text(parts: list[Column]) -> Column:
    """Key columns as one text, as row_key makes it."""
    texts = [p.cast("string") for p in parts]
    return texts[0] if len(texts) == 1 else F.when(~any_of([t.isNull() for t in texts]), F.to_json(F.array(*texts)))


def partition_key(table="table", company="companyId", location="locationId", entity: str | Column | None = None) -> Column:
    """table.company.location.entity; null is none, an empty string stays."""
    entity = entity_id() if entity is None else c(entity)
    return F.concat_ws(".", c(table), F.coalesce(c(company), F.lit("none")), F.coalesce(c(location), F.lit("none")), entity)


def message_key(table="table", operation="operation", company="companyId", location="locationId", event="id") -> Column:
    return F.concat_ws(".", F.lit("dbchange"), c(table), c(operation), F.coalesce(c(company), F.lit("none")), F.coalesce(c(location), F.lit("none")), c(event))


def object_path(prefix: str | None = None, table="table", timestamp="timestamp", event="id") -> Column:
    """prefix/table/timestamp-id.json"""
    name = F.concat(c(table), F.lit("/"), c(timestamp).cast("string"), F.lit("-"), c(event), F.lit(".json"))
    prefix = (prefix or "").strip("/")
    return F.concat(F.lit(prefix + "/"), name) if prefix else name


def omit(json: str | Column, names: list[str]) -> Column:
    """The payload without some keys; null and what is not an object stay as they are."""
    json = c(json)
    pairs = F.from_json(json, T.MapType(T.StringType(), T.VariantType()))
    kept = F.map_filter(pairs, lambda k, _: ~F.array_contains(F.array(*[F.lit(n) for n in names]), k)) if names else pairs
    return F.coalesce(F.to_json(kept), json)


def event_json(columns: list[str]) -> Column:
    """All fields as JSON, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def log_row() -> list[Column]:
    """The event as a row of the log."""
    return [
        F.col("id").alias("_event_id"),
        F.col("operation").alias("_operation"),
        entity_id().alias("_entity_id"),
        F.col("timestamp").alias("_timestamp"),
        F.when(F.col("mvccTimestamp") != "", F.col("mvccTimestamp")).alias("_mvcc_ts"),
        F.col("companyId").alias("_company_id"),
        F.col("locationId").alias("_location_id"),
        F.coalesce("modelVersion", F.lit("")).alias("_model_ver"),
        F.when(F.size("diff") > 0, F.to_json("diff")).alias("_diff"),
        F.col("before").alias("_before"),
        F.col("after").alias("_after"),
    ]


def dead_letter(error: Column, retries: Column) -> list[Column]:
    """The event as a row of the dead-letter table; the error is cut to MAX_ERROR characters."""
    return [
        F.col("id").alias("event_id"),
        F.col("operation").alias("operation"),
        F.col("table").alias("table_name"),
        F.col("companyId").alias("company_id"),
        F.col("locationId").alias("location_id"),
        payload().alias("payload"),
        F.substring(error, 1, MAX_ERROR).alias("error"),
        retries.cast("int").alias("retry_count"),
        F.current_timestamp().alias("failed_at"),
    ]


def is_identifier(name: str | Column) -> Column:
    return c(name).rlike(IDENTIFIER)


def is_number(text: str | Column) -> Column:
    return c(text).rlike(NUMBER)


def number_or_null(text: str | Column) -> Column:
    return F.when(is_number(text), c(text).try_cast("double"))


def typed(text: Column, to: T.DataType) -> Column:
    """Text from a payload in a column's type; null if it does not fit."""
    if isinstance(to, T.TimestampType):
        return F.try_to_timestamp(text)
    if isinstance(to, T.LongType):
        return F.coalesce(text.try_cast("long"), F.when(is_number(text), text.try_cast("double").try_cast("long")))
    return text.try_cast(to)


def utc_text(text: str | Column) -> Column:
    """A date-time as UTC text with microseconds, or the text itself if it is none (session time zone UTC)."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c(text)), "yyyy-MM-dd HH:mm:ss.SSSSSS"), c(text))


def without_credentials(url: str | Column) -> Column:
    """scheme://host:port/path of a URL; anything else unchanged."""
    u = c(url)
    bare = F.regexp_replace(F.regexp_replace(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://)[^@/?#]*@", "$1"), r"[?#].*$", "")
    return F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), F.regexp_replace(bare, "/+$", "")).otherwise(u)


def exponential_bounds(start: float, factor: float, count: int) -> list[float]:
    return [start * factor**k for k in range(count)]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def nanos_to_millis(text: str | Column) -> Column:
    return F.floor(c(text).try_cast("decimal(38,0)") / 1_000_000).cast("long")


def for_tenants(events: DataFrame, companies: list[str] | None = None, tables: list[str] | None = None, locations: list[str] | None = None, since_ms: int | None = None) -> DataFrame:
    """Events of some companies, tables (whatever the case) and locations, later than a time; None is all. Comparisons reach
    the scan."""
    if since_ms is not None:
        events = events.where(F.col("timestamp") > since_ms)
    for column, wanted in (("companyId", companies), ("locationId", locations)):
        if wanted is not None:
            events = events.where(F.col(column).isin(wanted))
    return events if tables is None else events.where(F.lower("table").isin([t.lower() for t in tables]))
