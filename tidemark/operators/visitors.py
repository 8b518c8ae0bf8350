"""Unique visitors per window: exact, by bit array, and by sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.strings import visitor_bucket
from tidemark.operators.windows import tumbling


def _views(behavior: DataFrame, view: str) -> DataFrame:
    return behavior.filter(F.col("behavior") == view)


def exact(behavior: DataFrame, size: str = "1 hour", view: str = "pv") -> DataFrame:
    """Distinct users: reduced to (window, user) on the map side, never one set per window."""
    return tumbling(_views(behavior, view), [], "ts", size, F.count_distinct("user_id").alias("uv"))


def by_bits(behavior: DataFrame, size: str = "1 hour", view: str = "pv") -> DataFrame:
    """Number of set bits of a 256-bit array with one bit per visitor hash; at most 256."""
    views = _views(behavior, view).withColumn("bucket", visitor_bucket(F.col("user_id")))
    return tumbling(views, [], "ts", size, F.count_distinct("bucket").alias("uv"))


def approximate(behavior: DataFrame, size: str = "1 hour", view: str = "pv", error: float = 0.01) -> DataFrame:
    """Distinct users by a fixed-size sketch per window, whatever their number."""
    return tumbling(_views(behavior, view), [], "ts", size, F.approx_count_distinct("user_id", error).alias("uv"))
