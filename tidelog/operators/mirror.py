"""The mirror of a table: the state that its events leave, applied in order of arrival."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.events import fields, is_delete, is_update, key_text, payload, row_key, typed
from tidelog.model import Schema


def empty_mirror(spark, schema: Schema) -> DataFrame:
    return spark.createDataFrame([], schema.struct())


def changes(events: DataFrame, schema: Schema, seq: str = "seq", older: Iterable[Schema] = ()) -> DataFrame:
    """What the fold needs of events: key, seq, whether they delete, the columns they are limited to, those that the version of
    their model has (null: all), and the values.

    ``seq`` is a column of their order of arrival. Deletes match the mirror's key by the segments after the first. ``older``
    are the table's schemas in other versions: an event of one of them sets no column that its version doesn't have.
    """
    names = schema.columns
    key = row_key(schema.keys)
    parsed = events.withColumn("_p", fields(payload(), names))
    values = F.struct(*[typed(F.col("_p").getField(n), schema.properties[n].spark_type).alias(n) for n in names])
    limited = F.when(is_update() & (F.coalesce(F.size("diff"), F.lit(0)) > 0), F.col("diff"))
    known = F.lit(None).cast("array<string>")
    for s in older:
        known = F.when(F.col("modelVersion") == s.version, F.array(*[F.lit(n) for n in s.columns if n in names]).cast("array<string>")).otherwise(known)
    return parsed.select(key.alias("key"), F.col(seq).cast("long").alias("seq"), is_delete().alias("deletes"), limited.alias("only"), known.alias("known"), values.alias("values"))


def fold(base: DataFrame, changed: DataFrame, schema: Schema, diff_aware: bool = True) -> DataFrame:
    """The mirror after changes (of ``changes``), which take effect in order of seq.

    An insert, or an update without a list of columns, sets all columns. A limited update sets the listed columns if the row
    exists, else the whole payload is inserted. A delete removes the row. With ``diff_aware=False`` every update sets all
    columns. A null that is set stays; the mirror's key columns come from the event's key. Events whose key has a null column
    match nothing and are left out.

    Two aggregations with map-side combine and equi-joins, no windows: a key with any share of the events makes one
    partial row per task. The last delete of each key is found first; of the events after it the first and, per column,
    the last one that sets it are enough.
    """
    names = [n for n in schema.columns if n not in schema.keys]
    only = F.col("only") if diff_aware else F.lit(None).cast("array<string>")
    changed = changed.where("key is not null").withColumn("only", only)
    ends = changed.groupBy("key").agg(F.max(F.when(F.col("deletes"), F.col("seq"))).alias("deleted"))
    gone = ends.where("deleted is not null")
    live = changed.where("not deletes").join(gone.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k"), "left").where("deleted is null or seq > deleted")

    def last(n: str) -> Column:
        sets = (F.col("only").isNull() | F.array_contains("only", n)) & (F.col("known").isNull() | F.array_contains("known", n))
        return F.max_by(F.when(sets, F.struct(F.col("values").getField(n).alias("v"))), F.when(sets, F.col("seq"))).alias(f"last_{n}")

    net = live.groupBy("key").agg(F.min_by("values", "seq").alias("first"), *[last(n) for n in names])
    base = base.withColumn("_key", key_text([F.col(f"`{n}`") for n in schema.keys]))
    base = base.join(gone.select(F.col("key").alias("_gone")), F.col("_key") == F.col("_gone"), "left_anti").withColumn("_there", F.lit(True))
    both = base.join(net, base["_key"] == net["key"], "full_outer")
    there = F.coalesce("_there", F.lit(False))

    def value(n: str) -> Column:
        to = schema.properties[n].spark_type
        old = F.struct((F.col(f"`{n}`").try_cast(to) if n in base.columns else F.lit(None).cast(to)).alias("v"))
        first = F.struct(F.col("first").getField(n).alias("v"))
        return F.coalesce(F.col(f"last_{n}"), F.when(there, old), first)["v"].alias(n)

    parts = F.from_json("key", "array<string>")

    def key_value(i: int, n: str) -> Column:
        to = schema.properties[n].spark_type if n in schema.properties else base.schema[n].dataType
        own = F.col("key") if len(schema.keys) == 1 else F.get(parts, F.lit(i))
        return F.coalesce(F.col(f"`{n}`").try_cast(to), own.try_cast(to)).alias(n)

    return both.select(*[key_value(i, n) for i, n in enumerate(schema.keys)], *[value(n) for n in names])


def apply_events(base: DataFrame, events: DataFrame, schema: Schema, seq: str = "seq", diff_aware: bool = True, older: Iterable[Schema] = ()) -> DataFrame:
    return fold(base, changes(events, schema, seq, older), schema, diff_aware)
