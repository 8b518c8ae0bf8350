"""Stream sinks: console and memory, tables, and one sink per output of an operator."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def to_console(df: DataFrame, mode: str = "append", label: str | None = None) -> StreamingQuery:
    """Print each new row, behind a label if one is given."""
    shown = df if label is None else df.select(F.lit(label).alias("label"), "*")
    return shown.writeStream.format("console").outputMode(mode).option("truncate", "false").start()


def to_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a Parquet table, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def route(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]]) -> None:
    """Send the rows of each ``output`` to its own sink, reading the input once."""
    df.persist()
    try:
        for output, write in sinks.items():
            write(df.filter(F.col("output") == output).drop("output"))
    finally:
        df.unpersist()


def route_stream(
    df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], None]], checkpoint: str
) -> StreamingQuery:
    """The same for a stream, batch by batch; runs over what is there now."""
    return (
        df.writeStream.foreachBatch(lambda batch, _: route(batch, sinks))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
