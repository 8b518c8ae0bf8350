"""Joins on a key and a time range, by time buckets.

The bucket joins the equi keys: a key with many rows is split along time, and a row only meets
rows of its neighbourhood. A left row is in one bucket, a right row in the one or two that its
possible partners are in. A bucket is ``RANGES`` ranges wide, so one right row in ``RANGES`` is
copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durations import floor_to, micros, position


RANGES = 4


def left_bucket(at: Column, lower: int, upper: int) -> Column:
    """Bucket of a left time, in microseconds."""
    return floor_to(at, max(upper - lower, 1) * RANGES)


def right_buckets(at: Column, lower: int, upper: int) -> Column:
    """Buckets of the left times from ``at - upper`` to ``at - lower``, as an array."""
    width = max(upper - lower, 1) * RANGES
    return F.array_distinct(F.array(floor_to(at - upper, width), floor_to(at - lower, width)))


def range_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str | int,
    upper: str | int,
) -> DataFrame:
    """Inner join on equal keys with ``left_ts + lower <= right_ts <= left_ts + upper``.

    Apart from the keys the two sides share no column names.
    """
    lower, upper = micros(lower), micros(upper)
    near = left.withColumn("_at_left", position(left, left_ts)).withColumn(
        "_bucket", left_bucket(F.col("_at_left"), lower, upper)
    )
    far = right.withColumn("_at_right", position(right, right_ts)).withColumn(
        "_bucket", F.explode(right_buckets(F.col("_at_right"), lower, upper))
    )
    gap = F.col("_at_right") - F.col("_at_left")
    return (
        near.join(far, [*keys, "_bucket"])
        .filter(gap.between(lower, upper))
        .drop("_bucket", "_at_left", "_at_right")
    )
