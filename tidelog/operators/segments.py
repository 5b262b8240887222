"""Runs of equal values along an order, and the segments of a batch between changes of a table's version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of the order in one span.
SPAN = 1 << 14


def segmented(rows: DataFrame, value: str, order: str, keys: tuple[str, ...] = (), span: int = SPAN) -> DataFrame:
    """rows with ``segment``: how often the value has changed among the rows of the same keys, up to this one. Null is a value and a key
    like others. ``order`` is a column of whole numbers, unique within the keys.

    Rows are numbered in spans of the order. Of a span only its edges go further, the first and last value and its number of
    changes, and only these are put in order for all spans of a key.
    """
    names = [f"_key{k}" for k in range(len(keys))]
    df = rows.withColumn("_span", F.floor(F.col(order) / span))
    inside = Window.partitionBy(*keys, "_span").orderBy(order)
    place = F.struct(F.col(value).alias("v"))
    before = F.lag(place).over(inside)
    df = df.withColumn("_turn", F.when(before.isNotNull() & ~before.eqNullSafe(place), 1).otherwise(0))
    edges = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_span").alias("_of")).agg(F.min_by(place, order).alias("_first"), F.max_by(place, order).alias("_last"), F.sum("_turn").alias("_n"))
    spans = Window.partitionBy(*names).orderBy("_of")
    last = F.lag("_last").over(spans)
    met = edges.withColumn("_met", F.when(last.isNotNull() & ~last.eqNullSafe(F.col("_first")), 1).otherwise(0))
    base = met.select(*names, "_of", (F.sum(F.col("_met") + F.col("_n")).over(spans.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))
    same = F.col("_span") == F.col("_of")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    count = F.sum("_turn").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_i", count).join(base, same).select(*rows.columns, (F.col("_base") + F.col("_i")).cast("long").alias("segment"))


def version_starts(events: DataFrame, ranks: dict[tuple[str, str], int], seq: str = "seq") -> DataFrame:
    """Where each table moves on to a later version of its model: table (lower case), version, rank and start, the seq of the first event
    of that version, if no event before it has a version as late. ``ranks`` tells how late the versions of (table, version) are;
    events of others move nothing on. One aggregation, with a row for each version."""
    known = F.create_map(*[x for (t, v), rank in ranks.items() for x in (F.array(F.lit(t), F.lit(v)), F.lit(rank))]) if ranks else F.create_map().cast("map<array<string>,int>")
    table = F.lower("table")
    rank = F.try_element_at(known, F.array(table, F.col("modelVersion")))
    first = events.select(table.alias("table"), F.col("modelVersion").alias("version"), rank.alias("rank"), F.col(seq).alias("_at")).where("rank is not null")
    first = first.groupBy("table", "version", "rank").agg(F.min("_at").alias("start"))
    earlier = Window.partitionBy("table").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return first.withColumn("_top", F.max("rank").over(earlier)).where("_top is null or rank > _top").drop("_top")


def version_segments(events: DataFrame, ranks: dict[tuple[str, str], int], seq: str = "seq") -> DataFrame:
    """events with ``segment``: how many versions their table has moved on to, up to this event. An event of an earlier version belongs to
    the segment that it comes in."""
    starts = version_starts(events, ranks, seq).groupBy(F.col("table").alias("_of")).agg(F.collect_list("start").alias("_starts"))
    joined = events.join(starts, F.lower("table") == F.col("_of"), "left")
    n = F.size(F.filter(F.coalesce("_starts", F.array().cast("array<bigint>")), lambda s: s <= F.col(seq)))
    return joined.select(*events.columns, n.cast("long").alias("segment"))
