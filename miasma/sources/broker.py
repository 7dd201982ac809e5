"""Kafka source and sink. The connector must be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(spark: SparkSession, servers: str, topic: str,
               starting_offsets: str = "latest", **options) -> DataFrame:
    """Unbounded records of one topic; only ``value`` matters downstream."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .options(**options).load())


def write_topic(payload: DataFrame, servers: str, topic: str, **options) -> None:
    """Send a ``value`` column to a topic; executors write in parallel."""
    (payload.write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("topic", topic).options(**options).save())
