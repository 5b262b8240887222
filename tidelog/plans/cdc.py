"""A change log derived from the events table, for queries that need one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.model import Property, Schema

#: Columns of the derived table: an id, a value, a kind and the payload's own number.
ACCOUNTS = Schema("accounts", "1", {"id": Property(), "amount": Property("number", nullable=True), "kind": Property(nullable=True), "k": Property("integer", nullable=True)}, ("id",), ("id",))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(ts: str):
    """Milliseconds of Unix time of a timestamp without zone, whatever the session's zone."""
    seconds = F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000 + F.floor(F.expr(f"extract(SECOND FROM {ts})") * 1000).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events: signup inserts, error deletes, all else updates; view is limited to amount."""
    e = load(spark, sf_dir, "events")
    operation = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "DELETE").otherwise("update")
    row = F.to_json(F.struct(F.col("user_id").cast("string").alias("id"), F.col("value").alias("amount"), F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("long").alias("k")))
    before = F.lag(row).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    deleted = F.col("event_type") == "error"
    user = F.col("user_id").cast("string")
    return e.select(
        (F.col("event_id") + 1).alias("seq"),
        operation.alias("operation"),
        F.col("event_id").cast("string").alias("id"),
        F.lit("accounts").alias("table"),
        F.when(deleted, F.array(F.lit(""), user)).otherwise(F.array(user)).alias("key"),
        F.lit("1").alias("modelVersion"),
        (F.col("user_id") % 7).cast("string").alias("companyId"),
        F.when(F.col("user_id") % 5 != 0, (F.col("user_id") % 3).cast("string")).alias("locationId"),
        F.lit(None).cast("string").alias("userId"),
        before.alias("before"),
        F.when(~deleted, row).alias("after"),
        F.when(F.col("event_type") == "view", F.array(F.lit("amount"), F.lit("unknown"))).alias("diff"),
        millis("ts").alias("timestamp"),
        F.lit("").alias("mvccTimestamp"),
        F.lit(False).alias("imported"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of those events."""
    from tidelog.functions.events import log_row

    return events(spark, sf_dir).select(F.col("seq").alias("_seq"), *log_row())


def mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as the mirror's baseline; it has no column k."""
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("kind"))


#: The same in SQL: ev is the change log, base the mirror.
SQL = """
with raw as (
  select event_id, ts, user_id, event_type, value, cast(props->>'$.k' as bigint) k,
         epoch_us(ts) // 1000 as ms from events),
ev as (
  select event_id + 1 as seq, case event_type when 'signup' then 'insert' when 'error' then 'DELETE' else 'update' end as operation,
         cast(event_id as varchar) as id, cast(user_id as varchar) as entity, cast(user_id % 7 as varchar) as company,
         case when user_id % 5 <> 0 then cast(user_id % 3 as varchar) end as location, ms,
         event_type = 'error' as deletes, event_type = 'view' as is_diff,
         value as amount, event_type as kind, k, user_id,
         lag(value) over w as b_amount, lag(event_type) over w as b_kind, lag(k) over w as b_k
  from raw window w as (partition by user_id order by ts, event_id)),
base as (select cast(c_custkey as varchar) as id, c_acctbal as amount, c_mktsegment as kind from customer)
"""
