"""Durations, and event times as microseconds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros(duration: str | int) -> int:
    """``"5 minutes"`` -> 300000000; an int is taken as microseconds already."""
    if isinstance(duration, int):
        return duration
    return int(pd.Timedelta(duration).value // 1000)


def interval(duration: str | int) -> Column:
    """The duration as an interval literal, to add to or take from a timestamp."""
    return F.expr(f"INTERVAL {micros(duration)} MICROSECOND")


def position(df: DataFrame, name: str) -> Column:
    """An integral or timestamp column as a bigint that orders the same way.

    Timestamps without a zone are read in the session zone, which the library pins to UTC.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    raise TypeError(f"{name} is {kind.simpleString()}; need a timestamp or an integer")


def from_position(value: Column, like: T.DataType) -> Column:
    """Turn a :func:`position` back to the type it came from."""
    if isinstance(like, T.TimestampNTZType):
        return F.timestamp_micros(value).cast("timestamp_ntz")
    if isinstance(like, T.TimestampType):
        return F.timestamp_micros(value)
    return value.cast(like)


def floor_to(value: Column, step: int) -> Column:
    """The largest multiple of ``step`` at or below a bigint column."""
    return value - F.pmod(value, F.lit(step).cast("bigint"))
