"""Views over the log of a table: current state, history, and both with the mirror."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.functions.events import fields, is_delete, key_text, typed
from tidelog.model import HISTORY_COLUMNS, Schema


def newest(log: DataFrame) -> DataFrame:
    """The newest event of each entity, deletes included, with its rank ``rn``. Spark keeps the best row of each entity and
    task before the shuffle, so an entity with very many events costs no more there."""
    order = Window.partitionBy("_entity_id").orderBy(F.desc_nulls_last("_timestamp"), F.desc_nulls_last("_seq"))
    return log.withColumn("rn", F.row_number().over(order).cast("long")).where("rn = 1")


def current(log: DataFrame) -> DataFrame:
    """The newest event of each entity that is not deleted: the log's columns and ``rn``."""
    return newest(log).where(~is_delete("_operation"))


def current_stream(log: DataFrame) -> DataFrame:
    """Changes of the current view, from a stream of log rows: each entity's newest event (by time, then sequence) whenever that
    changes, deletes included, so that the newest row of an entity is its state. Events that are older than what was emitted
    for their entity change nothing. A key's state is a time and a sequence number; of a batch each entity emits one row."""
    columns = [f"`{c}`" for c in log.columns]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, seq = state.get if state.exists else (None, None)
        best = None
        for frame in frames:
            order = [(-1 if pd.isna(t) else 1, 0 if pd.isna(t) else int(t), -1 if pd.isna(s) else 1, 0 if pd.isna(s) else int(s)) for t, s in zip(frame["_timestamp"], frame["_seq"], strict=True)]
            i = max(range(len(order)), key=order.__getitem__)
            if best is None or order[i] > best[0]:
                best = order[i], frame.iloc[[i]]
        last = None if at is None else (1 if at[0] else -1, at[1], 1 if seq[0] else -1, seq[1])
        if best is not None and (last is None or best[0] > last):
            state.update(([best[0][0] > 0, best[0][1]], [best[0][2] > 0, best[0][3]]))
            yield best[1]

    kind = "at struct<there:boolean,value:bigint>, seq struct<there:boolean,value:bigint>"
    return log.select(*columns).groupBy("_entity_id").applyInPandasWithState(run, log.schema, kind, "append", GroupStateTimeout.NoTimeout)


def project(log: DataFrame, schema: Schema, keep: list[str], strict_nulls: bool = False, cast: bool = False) -> DataFrame:
    """Columns of the payload, each from after and else from before. Both JSON texts are parsed once.

    A field that an update set to null shows its value before, as after it has none; with ``strict_nulls`` it is null.
    """
    names = schema.columns
    if not names:
        return log.select(*keep)
    parsed = log.withColumn("_a", fields("_after", names)).withColumn("_b", fields("_before", names))

    def value(n: str):
        a, b = F.col("_a").getField(n), F.col("_b").getField(n)
        v = F.when(F.col("_after").isNotNull(), a).otherwise(b) if strict_nulls else F.coalesce(a, b)
        return (typed(v, schema.properties[n].spark_type) if cast else v).alias(n)

    return parsed.select(*keep, *[value(n) for n in names])


def history(log: DataFrame, schema: Schema, strict_nulls: bool = False) -> DataFrame:
    """Every event: what the log says of it, then the payload's columns as text."""
    return project(log, schema, HISTORY_COLUMNS, strict_nulls)


def unified(log: DataFrame, mirror: DataFrame, schema: Schema, strict_nulls: bool = False) -> DataFrame | None:
    """Current rows of the log, and mirror rows of entities without any event. Both sides have the schema's types;
    columns that the mirror lacks (whatever the case of the name) are null there. Without columns there is no view. Rows of a
    key of several columns are told apart by the payload's columns."""
    names = schema.columns
    if not names:
        return None
    there = {x.lower(): x for x in mirror.columns}
    if len(schema.keys) > 1:
        # an event's entity is only the last column of such a key; the payload has all
        own = fields(F.coalesce("_after", "_before"), list(schema.keys))
        log = log.withColumn("_entity_id", F.coalesce(key_text([own.getField(n) for n in schema.keys]), "_entity_id"))
    live = project(current(log), schema, [], strict_nulls, cast=True)
    if all(k.lower() in there for k in schema.keys):
        seen = log.select(F.col("_entity_id").alias("_seen")).distinct()
        mirror = mirror.join(seen, key_text([mirror[f"`{there[k.lower()]}`"] for k in schema.keys]) == F.col("_seen"), "left_anti")

    def own(n: str):
        to = schema.properties[n].spark_type
        return (F.col(f"`{there[n.lower()]}`").try_cast(to) if n.lower() in there else F.lit(None).cast(to)).alias(n)

    return live.unionByName(mirror.select(*[own(n) for n in names]))


def register(spark: SparkSession, log: DataFrame, schema: Schema, mirror: DataFrame | None = None) -> list[str]:
    """Temporary views current_t, t_history and, with a mirror, t_unified; registering again replaces them."""
    views = {f"current_{schema.table}": current(log), f"{schema.table}_history": history(log, schema)}
    if mirror is not None and schema.columns:
        views[f"{schema.table}_unified"] = unified(log, mirror, schema)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
