"""Sliding windows by panes.

``F.window`` with a slide turns each row into size / slide rows before it aggregates. Here rows
are first reduced to panes one slide wide (map-side, so a hot key is small before it moves), and
panes are shuffled by (key, block of windows). A block is a run of ``BLOCK_SIZES`` window lengths,
so one key over a long time range is still split over many tasks; a pane near a block edge goes to
two blocks. Inside a block:

* counts and sums of integers can be taken back, so a pane is two changes: it enters at the first
  window that holds it and leaves after the last. A running sum of the changes gives the value of
  each stretch of windows, and a row is made only for each window of the result;
* other aggregates spread each pane over the windows it is in, and merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.durations import floor_to, from_position, micros, position

BLOCK_SIZES = 16


@dataclass(frozen=True)
class Merge:
    """An aggregate that can be computed per pane and merged: count, sum, min or max."""

    kind: str
    value: Column

    def per_pane(self) -> Column:
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.value)

    def merged(self, part: Column) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](part)


def count_rows() -> Merge:
    return Merge("count", F.lit(1))


def sum_of(value: Column | str) -> Merge:
    return Merge("sum", _col(value))


def min_of(value: Column | str) -> Merge:
    return Merge("min", _col(value))


def max_of(value: Column | str) -> Merge:
    return Merge("max", _col(value))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str | int,
    slide: str | int,
    **aggs: Merge,
) -> DataFrame:
    """One row per key and non-empty window: keys, window_start, window_end, aggregates."""
    size, slide = micros(size), micros(slide)
    if size % slide:
        return sliding_plain(df, keys, ts, size, slide, **aggs)
    kind = df.schema[ts].dataType
    block = BLOCK_SIZES * size
    pane, first, last = F.col("_pane"), F.col("_first"), F.col("_last")
    sums = [n for n, a in aggs.items() if a.kind == "sum"]
    panes = df.groupBy(*keys, floor_to(position(df, ts), slide).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[a.per_pane().alias(f"_{n}") for n, a in aggs.items()],
        *[F.count(aggs[n].value).alias(f"_has_{n}") for n in sums],
    )
    spread = (
        panes.withColumns({"_first": floor_to(pane - size + slide, block), "_last": floor_to(pane, block)})
        .withColumn("_block", F.explode(F.array_distinct(F.array(first, last))))
        .drop("_first", "_last")
    )
    spread = before_fan_out(spread, *keys, "_block")
    taken_back = all(
        a.kind == "count" or a.kind == "sum" and isinstance(spread.schema[f"_{n}"].dataType, T.IntegralType)
        for n, a in aggs.items()
    )
    in_block = _by_changes if taken_back else _by_merging
    return in_block(spread, list(keys), size, slide, block, aggs).select(
        *keys,
        from_position(F.col("_start"), kind).alias("window_start"),
        from_position(F.col("_start") + size, kind).alias("window_end"),
        *aggs,
    )


def _by_merging(spread, keys, size, slide, block, aggs) -> DataFrame:
    starts = F.sequence(
        F.greatest(F.col("_pane") - size + slide, F.col("_block")),
        F.least(F.col("_pane"), F.col("_block") + block - slide),
        F.lit(slide).cast("bigint"),
    )
    return (
        spread.withColumn("_start", F.explode(starts))
        .groupBy(*keys, "_block", "_start")
        .agg(*[a.merged(F.col(f"_{n}")).alias(n) for n, a in aggs.items()])
    )


def _by_changes(spread, keys, size, slide, block, aggs) -> DataFrame:
    parts = ["_rows", *[f"_{n}" for n in aggs], *[f"_has_{n}" for n, a in aggs.items() if a.kind == "sum"]]
    enters = F.greatest(F.col("_pane") - size + slide, F.col("_block"))
    leaves = F.col("_pane") + slide
    stop = F.col("_block") + block
    changes = (
        spread.withColumn(
            "_change",
            F.explode(
                F.array(
                    F.struct(enters.alias("at"), *[F.col(p).alias(p) for p in parts]),
                    F.struct(leaves.alias("at"), *[(-F.col(p)).alias(p) for p in parts]),
                )
            ),
        )
        .select(*keys, "_block", "_change.*")
        .filter(F.col("at") < stop)
        .groupBy(*keys, "_block", "at")
        .agg(*[F.sum(p).alias(p) for p in parts])
    )
    # At most two changes per pane of a block: these windows are small whatever the key.
    along = Window.partitionBy(*keys, "_block").orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    stretches = changes.withColumns(
        {**{p: F.sum(p).over(so_far) for p in parts}, "_next": F.coalesce(F.lead("at").over(along), stop)}
    ).filter(F.col("_rows") > 0)
    values = {
        n: F.when(F.col(f"_has_{n}") > 0, F.col(f"_{n}")) if a.kind == "sum" else F.col(f"_{n}")
        for n, a in aggs.items()
    }
    starts = F.sequence(F.col("at"), F.col("_next") - slide, F.lit(slide).cast("bigint"))
    return stretches.select(*keys, *[c.alias(n) for n, c in values.items()], F.explode(starts).alias("_start"))


def before_fan_out(df: DataFrame, *by: str) -> DataFrame:
    """Shuffle rows that are about to be multiplied.

    The number of partitions is given, because adaptive execution would merge partitions by their
    size before the rows fan out, and leave the larger part of the work to a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def sliding_plain(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str | int,
    slide: str | int,
    **aggs: Merge,
) -> DataFrame:
    """The same result through ``F.window``: for streams, and sizes no slide divides."""
    window = F.window(ts, f"{micros(size)} microseconds", f"{micros(slide)} microseconds")
    return (
        df.groupBy(*keys, window.alias("_window"))
        .agg(*[a.per_pane().alias(n) for n, a in aggs.items()])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *aggs,
        )
    )


def early_firing(
    df: DataFrame, keys: Sequence[str], ts: str, size: str | int, step: str | int
) -> DataFrame:
    """Cumulative counts of each tumbling window at every step boundary, and at its end.

    A boundary ``b`` counts the rows before it, and shows even when nothing arrived since the last
    one; boundaries up to the first row of the window do not show.
    """
    size, step = micros(size), micros(step)
    if size % step:
        raise ValueError("the step must divide the window size")
    kind = df.schema[ts].dataType
    pos = position(df, ts)
    # A pane's running count holds from its own boundary to the next pane's, or to the window's end.
    order = Window.partitionBy(*keys, "_start").orderBy("_pane")
    until = F.coalesce(F.lead("_pane").over(order), F.col("_start") + size)
    return (
        df.groupBy(*keys, floor_to(pos, size).alias("_start"), floor_to(pos, step).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .transform(before_fan_out, *keys, "_start")
        .select(*keys, "_start", "_pane", until.alias("_until"), F.sum("_n").over(order).alias("count"))
        .withColumn("_at", F.explode(F.sequence(F.col("_pane") + step, F.col("_until"), F.lit(step).cast("bigint"))))
        .select(
            *keys,
            from_position(F.col("_start") + size, kind).alias("window_end"),
            from_position(F.col("_at"), kind).alias("fired_at"),
            "count",
        )
    )
