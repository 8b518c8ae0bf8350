"""Windowed aggregations. Sliding and early-firing forms are in ``tidemark.plans.panes``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.durations import micros
from tidemark.plans.panes import count_rows, early_firing, min_of, sliding, sliding_plain

__all__ = [
    "early_firing",
    "hop_count_sql",
    "marketing_by_channel",
    "marketing_total",
    "presence",
    "sliding",
    "sliding_min",
    "sliding_plain",
    "tumble_count_sql",
    "tumbling",
    "window_apply",
    "word_counts",
]


def tumbling(df: DataFrame, keys: Sequence[str], ts: str, size: str | int, *aggs: Column) -> DataFrame:
    """One row per key and window: keys, window_start, window_end, aggregates.

    Whether the caller thinks of it as a reduction, an accumulator or a function over the whole
    window, built-in aggregates are computed in part on the map side. Works on streams too.
    """
    window = F.window(ts, f"{micros(size)} microseconds")
    grouped = df.groupBy(*keys, window.alias("_window"))
    found = grouped.agg(*aggs) if aggs else grouped.agg(F.lit(True).alias("_any")).drop("_any")
    values = [c for c in found.columns if c not in (*keys, "_window")]
    return found.select(
        *keys,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *values,
    )


def window_apply(
    df: DataFrame, keys: Sequence[str], ts: str, size: str | int, function: Callable, schema: str
) -> DataFrame:
    """A user function over each whole window, for what no built-in aggregate can say.

    ``function`` takes the pandas rows of one (key, window), ``window_start`` and ``window_end``
    among them. A window must fit in a task's memory: prefer :func:`tumbling`.
    """
    window = F.window(ts, f"{micros(size)} microseconds")
    rows = df.withColumn("_window", window).withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    )
    return rows.drop("_window").groupBy(*keys, "window_start", "window_end").applyInPandas(function, schema)


def sliding_min(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, size: str = "10 seconds", slide: str = "5 seconds"
) -> DataFrame:
    """Smallest value per key over a sliding window."""
    return sliding(df, keys, ts, size, slide, min_value=min_of(value))


def word_counts(words: DataFrame, ts: str = "ts", size: str = "5 seconds") -> DataFrame:
    """Count of each word per window."""
    return tumbling(words, ["word"], ts, size, F.count(F.lit(1)).alias("count"))


def marketing_by_channel(
    behavior: DataFrame, size: str = "5 seconds", slide: str = "1 second", uninstall: str = "UNINSTALL"
) -> DataFrame:
    """Sliding count per channel and behaviour, leaving uninstalls out."""
    kept = behavior.filter(F.col("behavior") != uninstall)
    return sliding(kept, ["channel", "behavior"], "ts", size, slide, count=count_rows())


def marketing_total(
    behavior: DataFrame, size: str = "5 seconds", slide: str = "1 second", uninstall: str = "UNINSTALL"
) -> DataFrame:
    """Sliding count over all channels, leaving uninstalls out."""
    kept = behavior.filter(F.col("behavior") != uninstall)
    return sliding(kept, [], "ts", size, slide, count=count_rows())


def presence(df: DataFrame, keys: Sequence[str], ts: str, size: str | int, text: str = "hello world") -> DataFrame:
    """A constant per key and window that has any row."""
    return tumbling(df, keys, ts, size).withColumn("text", F.lit(text))


def tumble_count_sql(spark: SparkSession, view: str, size: str = "10 seconds") -> DataFrame:
    """Tumbling count per id, in SQL."""
    return spark.sql(
        f"SELECT id, w.end AS window_end, n AS count FROM "
        f"(SELECT id, window(ts, '{size}') AS w, count(id) AS n FROM {view} GROUP BY ALL)"
    )


def hop_count_sql(spark: SparkSession, view: str, size_minutes: int, slide_minutes: int) -> DataFrame:
    """Sliding count per id, in SQL: counts per pane, then each pane to the windows it is in."""
    return spark.sql(
        f"""
        WITH panes AS (
          SELECT id, window(ts, '{slide_minutes} minutes').end AS pane_end, count(*) AS n
          FROM {view} GROUP BY ALL
        )
        SELECT id, window_end, sum(n) AS count
        FROM (SELECT id, n, explode(sequence(pane_end,
                     pane_end + INTERVAL '{size_minutes - slide_minutes}' MINUTE,
                     INTERVAL '{slide_minutes}' MINUTE)) AS window_end FROM panes)
        GROUP BY id, window_end
        """
    )
