"""Kafka topics as sinks, for streams and for whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def writer_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options for one topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def messages(df: DataFrame, column: str) -> DataFrame:
    """One string column as message values."""
    return df.select(F.col(column).cast("string").alias("value"))


def write_topic(df: DataFrame, column: str, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Start a stream that sends a column to a topic."""
    writer = messages(df, column).writeStream.format("kafka").options(**writer_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).start()


def publish_file(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Send every line of a file or folder to a topic, in parallel."""
    lines = spark.read.text(path)
    messages(lines, "value").write.format("kafka").options(**writer_options(servers, topic)).save()
