"""Projections, filters, fan-outs, labelled parts, side outputs, unions and connected inputs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.strings import without_trailing_empty


def project(df: DataFrame, *columns: str) -> DataFrame:
    """Keep some columns."""
    return df.select(*columns)


def plus(df: DataFrame, column: str, amount: int = 1) -> DataFrame:
    """Add a constant to a column; overflow is an error."""
    return df.withColumn(column, F.col(column) + amount)


def only(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals a value."""
    return df.filter(F.col(column) == value)


def without(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column differs from a value."""
    return df.filter(F.col(column) != value)


def repeat_rows(df: DataFrame, times: Column, name: str = "copy") -> DataFrame:
    """Each row ``times`` times, none when it is zero; ``name`` numbers the copies from 1."""
    copies = F.when(times > 0, F.sequence(F.lit(1), times.cast("int")))
    return df.withColumn(name, F.explode(copies))


def tokenize(df: DataFrame, text: str, pattern: str, word: str = "word") -> DataFrame:
    """One row per word, with its position."""
    others = [c for c in df.columns if c != text]
    parts = df.select(*others, F.split(text, pattern).alias("_parts"))
    return parts.select(*others, F.posexplode(without_trailing_empty(F.col("_parts"))).alias("pos", word))


def label_parts(df: DataFrame, label: Column) -> DataFrame:
    """Name the part each row belongs to."""
    return df.withColumn("label", label)


def select_parts(df: DataFrame, *labels: str) -> DataFrame:
    """The rows of one or several parts."""
    return df.filter(F.col("label").isin(*labels))


def side_output(df: DataFrame, when: Column, tag: str, message: Column) -> DataFrame:
    """Every row on the ``main`` output, and a message on ``tag`` where a condition holds.

    One pass over the input; ``route`` in the sinks sends each output its own way.
    """
    main = F.struct(F.lit("main").alias("output"), F.lit(None).cast("string").alias("message"))
    extra = F.struct(F.lit(tag).alias("output"), message.alias("message"))
    outputs = F.array_compact(F.array(main, F.when(when, extra)))
    return df.withColumn("_out", F.explode(outputs)).select(*df.columns, "_out.output", "_out.message")


def union_all(*parts: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, parts)


def connect(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two inputs of different shape as one, ``source`` 1 or 2; missing columns are NULL."""
    return first.withColumn("source", F.lit(1)).unionByName(
        second.withColumn("source", F.lit(2)), allowMissingColumns=True
    )


def co_map(connected: DataFrame, keep: Sequence[str], first: Column, second: Column) -> DataFrame:
    """A value per row, from one function for the first input and another for the second."""
    value = F.when(F.col("source") == 1, first).otherwise(second)
    return connected.select(*keep, value.alias("value"))


def co_flat_map(
    connected: DataFrame, keep: Sequence[str], first: Column, second: Column, first_times: int, second_times: int
) -> DataFrame:
    """``co_map`` with a number of copies for each input."""
    times = F.when(F.col("source") == 1, F.lit(first_times)).otherwise(F.lit(second_times))
    value = F.when(F.col("source") == 1, first).otherwise(second)
    return repeat_rows(connected, times).select(*keep, "copy", value.alias("value"))
