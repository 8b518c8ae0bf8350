"""Watermarks in arrival order, and what becomes of late records.

A stream drops late rows without a trace, so they are told apart before any stateful step. The
watermark a record meets is the largest event time among the records that arrived before it, minus
the delay. Times are microseconds, so both of the usual "minus one millisecond" terms are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durations import floor_to, from_position, micros, position
from tidemark.plans.ordered import HotKeys, Ordered, next_row, running_count, running_max


def _with_watermark(df, arrival, ts, delay, hot, inclusive=False) -> DataFrame:
    """``_at`` and ``_wm``, both bigint; no watermark before the first record."""
    seen = Ordered(df.withColumn("_at", position(df, ts)), [], arrival, hot)
    seen = seen.running(_max=running_max(F.col("_at"), inclusive))
    return seen.rows().withColumn("_wm", F.col("_max") - micros(delay)).drop("_max")


def watermark_trace(
    df: DataFrame, arrival: Sequence[str], ts: str, delay: str | int, hot: HotKeys | None = None
) -> DataFrame:
    """Each record with the watermark it raises or leaves: largest time so far minus the delay."""
    kind = df.schema[ts].dataType
    rows = _with_watermark(df, arrival, ts, delay, hot, inclusive=True)
    return rows.withColumn("watermark", from_position(F.col("_wm"), kind)).drop("_at", "_wm")


def _late(edge: Column) -> Column:
    return F.col("_wm").isNotNull() & edge


def late_records(
    df: DataFrame, arrival: Sequence[str], ts: str, delay: str | int = 0, hot: HotKeys | None = None
) -> DataFrame:
    """Every record with ``output``: ``late`` if its time is before the watermark, else ``main``."""
    rows = _with_watermark(df, arrival, ts, delay, hot)
    late = _late(F.col("_at") < F.col("_wm"))
    return rows.withColumn("output", F.when(late, "late").otherwise("main")).drop("_at", "_wm")


def late_for_window(
    df: DataFrame,
    arrival: Sequence[str],
    ts: str,
    size: str | int = "10 seconds",
    delay: str | int = 0,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every record with its window end and ``output``: ``late`` if the window has already closed."""
    kind = df.schema[ts].dataType
    rows = _with_watermark(df, arrival, ts, delay, hot)
    end = floor_to(F.col("_at"), micros(size)) + micros(size)
    late = _late(end <= F.col("_wm"))
    return rows.withColumns(
        {"window_end": from_position(end, kind), "output": F.when(late, "late").otherwise("main")}
    ).drop("_at", "_wm")


def updating_windows(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    ts: str,
    size: str | int = "5 seconds",
    delay: str | int = "5 seconds",
    lateness: str | int = "5 seconds",
    hot: HotKeys | None = None,
) -> DataFrame:
    """What a window with allowed lateness emits: its first result, then one per late record.

    A record is on time while its window is open, an update for ``lateness`` after, then dropped.
    ``fired_by`` is the arrival tie-break of the late record, NULL for the firing at the window's
    end; ``is_update`` is false on the first firing of a window, whichever kind that is.
    """
    kind = df.schema[ts].dataType
    tie = arrival[-1]
    end = floor_to(position(df, ts), micros(size)) + micros(size)
    df = df.withColumn("_end", end)
    on_time = F.col("_wm").isNull() | (F.col("_end") > F.col("_wm"))
    counted = on_time | (F.col("_end") > F.col("_wm") - micros(lateness))
    rows = _with_watermark(df, arrival, ts, delay, hot).withColumn("_on_time", on_time).filter(counted)
    # The watermark only rises, so the on-time records of a window come before its late ones.
    counts = (
        Ordered(rows, [*keys, "_end"], arrival, hot, sizes_from=df)
        .running(_n=running_count(), _next=next_row(F.col("_on_time")))
        .rows()
    )
    late = ~F.col("_on_time")
    fires = late | ~F.coalesce(F.col("_next"), F.lit(False))
    return counts.filter(fires).select(
        *keys,
        from_position(F.col("_end"), kind).alias("window_end"),
        F.when(late, F.col(tie)).alias("fired_by"),
        (late & (F.col("_n") > 1)).alias("is_update"),
        F.col("_n").alias("count"),
    )
