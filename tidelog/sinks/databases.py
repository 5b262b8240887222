"""Tables of databases by JDBC: a batch is folded, staged in parallel, and merged in one transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.events import is_delete, row_key
from tidelog.model import Schema
from tidelog.operators.mirror import changes, empty_mirror, fold
from tidelog.sinks.dialects import merge
from tidelog.sinks.registry import Target


def staged(events: DataFrame, schema: Schema, seq: str = "seq") -> DataFrame:
    """One row per key of a batch, with ``_deleted``: the rows that its events leave, and the keys that they leave without one.

    The batch is folded over an empty mirror, so an update is merged with all of its payload's columns.
    """
    spark = events.sparkSession
    changed = changes(events, schema, seq)
    live = fold(empty_mirror(spark, schema), changed, schema, diff_aware=False).withColumn("_deleted", F.lit(False))
    last = events.withColumn("_k", row_key(schema.keys)).where("_k is not null").groupBy("_k").agg(F.max_by(is_delete(), seq).alias("gone")).where("gone")
    parts = F.from_json("_k", "array<string>")
    keys = [(F.col("_k") if len(schema.keys) == 1 else F.get(parts, F.lit(i))).try_cast(live.schema[k].dataType).alias(k) for i, k in enumerate(schema.keys)]
    return live.unionByName(last.select(*keys, F.lit(True).alias("_deleted")), allowMissingColumns=True)


def run_in_transaction(spark: SparkSession, target: Target, statements: list[str]) -> None:
    """Statements through the JVM's JDBC driver, all or none."""
    java = spark.sparkContext._jvm.java
    properties = java.util.Properties()
    for k, v in target.options.items():
        if k != "url":
            properties.setProperty(k, v)
    connection = java.sql.DriverManager.getConnection(target.options["url"], properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert(events: DataFrame, schema: Schema, target: Target, seq: str = "seq", run=run_in_transaction, stage=None) -> None:
    """Bring a batch of events into a table. Rows are staged by all tasks at once, in a table of their own that is replaced;
    then one transaction merges it, so a batch that is repeated changes nothing. ``run`` and ``stage`` stand in for the
    connection in tests."""
    name = f"{schema.table}__staging"
    rows = staged(events, schema, seq)
    if stage is None:
        rows.write.format("jdbc").options(**target.options).option("dbtable", name).mode("overwrite").save()
    else:
        stage(rows, name)
    run(events.sparkSession, target, merge(schema, name, target.scheme))
