"""Operational aggregates: progress, counters, histograms, status, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.events import exponential_bounds, partition_key

FLUSH_SECONDS = exponential_bounds(0.001, 2, 14)
FLUSH_COUNT = exponential_bounds(1, 2, 14)
PROCESSING_SECONDS = exponential_bounds(0.0001, 2, 16)


def histogram(df: DataFrame, value: str | Column, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative buckets: le (bound, null for infinity), n (values up to it), and the sum and count of all values.

    One aggregation with a counter per bound, whatever the input; only its row is unfolded.
    """
    v = F.col(value) if isinstance(value, str) else value
    counts = [F.count_if(v <= b).alias(f"b{k}") for k, b in enumerate(bounds)]
    row = df.groupBy(*(by or [])).agg(*counts, F.count(v).alias("count"), F.sum(v).alias("sum"))
    cells = [F.struct(F.lit(b).cast("double").alias("le"), F.col(f"b{k}").alias("n")) for k, b in enumerate(bounds)]
    cells.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("count").alias("n")))
    return row.select(*(by or []), "sum", "count", F.inline(F.array(*cells)))


def status(log: DataFrame, delivered_ms: int | None = None) -> DataFrame:
    """Events so far, the time of the last one and its table; with the time up to which events are delivered, also how many
    are pending."""
    pending = [] if delivered_ms is None else [F.count_if(F.col("timestamp") > delivered_ms).alias("pending")]
    return log.agg(*pending, F.count("*").alias("processed"), F.max("timestamp").alias("last_event_ms"), F.max_by("table", F.struct("timestamp", "table")).alias("last_table"))


def progress(jobs: DataFrame) -> DataFrame:
    """Of export jobs (table, status): done, total and a line like ``3/4 (75%)``."""
    row = jobs.agg(F.count_if(F.lower("status") == "completed").alias("done"), F.count("*").alias("total"))
    share = F.floor(F.when(F.col("total") > 0, 100 * F.col("done") / F.col("total")).otherwise(0)).cast("int")
    return row.withColumn("line", F.format_string("%d/%d (%d%%)", "done", "total", share))


def flush_batches(events: DataFrame, size: int, keys: list[str], order: str) -> DataFrame:
    """The batch of each event among those of its keys, size events each, in order. Events are counted per span of the order
    first, so one key may hold any share of them."""
    span = F.floor(F.col(order) / (1 << 14))
    df = events.withColumn("_span", span)
    counts = df.groupBy(*keys, "_span").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_base", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_span")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy(*keys, "_span").orderBy(order))
    df = df.withColumn("_i", number).join(counts, [*keys, "_span"])
    return df.withColumn("batch", F.floor((F.col("_base") + F.col("_i") - 1) / size)).drop("_span", "_i", "_base")


def in_key_order(events: DataFrame, order: str, partitions: int) -> DataFrame:
    """Events dealt out by partition key, in order within it."""
    return events.withColumn("_pk", partition_key()).repartition(partitions, "_pk").sortWithinPartitions("_pk", order).drop("_pk")


def transferred(files: DataFrame) -> DataFrame:
    """Files and bytes of a binaryFile listing."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
