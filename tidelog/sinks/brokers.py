"""Events as messages of brokers. The connectors are not bundled; these are the rows that they take."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.events import event_json, message_key, partition_key
from tidelog.functions.hashing import PARTITIONS, broker_partition

KAFKA_BATCH, EVENT_HUB_BATCH = 1000, 500
KAFKA_OPTIONS = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.batch.size": str(1 << 20)}


def kafka_rows(events: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """key, value, headers and partition for the Kafka sink."""
    own = partition_key()
    header = F.struct(F.lit("partition-key").alias("key"), own.cast("binary").alias("value"))
    return events.select(message_key().alias("key"), event_json(events.columns).alias("value"), F.array(header).alias("headers"), broker_partition(own, partitions).cast("int").alias("partition"))


def event_hub_rows(events: DataFrame) -> DataFrame:
    """Envelope for Event Hubs: partition key, message id, content type, body and properties."""
    properties = F.create_map(F.lit("table"), F.col("table"), F.lit("operation"), F.col("operation"), F.lit("companyId"), F.coalesce("companyId", F.lit("")))
    return events.select(partition_key().alias("partition_key"), F.col("id").alias("message_id"), F.lit("application/json").alias("content_type"), event_json(events.columns).alias("body"), properties.alias("properties"))


def write_kafka(events: DataFrame, servers: str, topic: str) -> None:
    kafka_rows(events).write.format("kafka").options(**KAFKA_OPTIONS).option("kafka.bootstrap.servers", servers).option("topic", topic).save()
