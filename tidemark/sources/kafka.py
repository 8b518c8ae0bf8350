"""Kafka topics as streams of lines. The connector jar is the cluster's to provide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    """Reader options: one topic, from the latest offsets unless told otherwise."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def message_text(messages: DataFrame) -> DataFrame:
    """The message values as lines, for the parsers."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None, start: str = "latest") -> DataFrame:
    """A topic as a streaming frame of lines."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, group, start))
    return message_text(reader.load())
