"""Kafka topics (needs Spark's Kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What identifies a record of a topic.
RECORD_KEYS = ["topic", "partition", "offset"]


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """A topic as a stream, optionally limited to so many offsets per trigger."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def write_topic(encoded: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish encoded messages (`key`, `value`) to a topic."""
    (
        encoded.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
