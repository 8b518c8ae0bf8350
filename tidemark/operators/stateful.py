"""Keyed state and timers over tables.

Per key, rows are taken in (event time, tie-break) order; a timer at T fires after every row with
time <= T and before any later one; at the end of the input all pending timers fire. The same
operators on streams are in ``tidemark.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.anchors import anchored_counts
from tidemark.plans.durations import from_position, interval, micros, position
from tidemark.plans.ordered import (
    HotKeys,
    Ordered,
    latest,
    next_row,
    previous_row,
    running_sum,
)


def value_change(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    threshold: float = 1.7,
    initial: float | None = 0.0,
    expire: str | int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows whose value differs from the one before by more than ``threshold``, with ``diff``.

    The first row of a key is compared with ``initial``; with None it never alerts. With
    ``expire`` a value older than that is forgotten and ``initial`` takes its place.
    """
    ts = order[0]
    steps = {"_prev": previous_row(F.col(value))}
    if expire is not None:
        steps["_prev_at"] = previous_row(position(df, ts))
    rows = Ordered(df, [key], order, hot).running(**steps).rows()
    prev = F.col("_prev")
    if expire is not None:
        prev = F.when(position(df, ts) - F.col("_prev_at") <= micros(expire), prev)
    if initial is not None:
        prev = F.coalesce(prev, F.lit(initial))
    return (
        rows.withColumn("diff", F.abs(F.col(value) - prev))
        .filter(F.col("diff") > threshold)
        .drop(*steps)
    )


def rise_alerts(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    hold: str | int = "1 second",
    hot: HotKeys | None = None,
) -> DataFrame:
    """An alert when a key's value, having begun to rise, has not fallen for ``hold``.

    At most one alert per run without a fall, at the time of its first rise plus ``hold``.
    """
    ts = order[0]
    kind = df.schema[ts].dataType
    at = position(df, ts)
    fell, rose = F.col(value) < F.col("_prev"), F.col(value) > F.col("_prev")
    runs = (
        Ordered(df, [key], order, hot)
        .running(_prev=previous_row(F.col(value)), _next=next_row(at))
        .with_columns({"_fell": F.when(fell, 1).otherwise(0).cast("bigint"), "_rise": F.when(rose, at)})
        .running(_run=running_sum(F.col("_fell")))
        .rows()
        .groupBy(key, "_run")
        .agg(F.min("_rise").alias("_rise"), _end_of_run())
    )
    due = F.col("_rise") + micros(hold)
    return runs.filter(_not_ended(due)).select(key, from_position(due, kind).alias("alert_at"))


def _end_of_run() -> Column:
    """Time of the row that ends a run, from each row's ``_next``: NULL when the key ends first."""
    return F.when(F.count(F.lit(1)) == F.count("_next"), F.max("_next")).alias("_end")


def _not_ended(due: Column) -> Column:
    return due.isNotNull() & (F.col("_end").isNull() | (F.col("_end") > due))


def anchored_windows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str | int = "10 seconds",
    hot: HotKeys | None = None,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Row counts of windows that open at a key's first row and stay open for ``size``, inclusive.

    The first row after a window closed opens the next one. Gives keys, anchor, fired_at, count.
    Key sizes are counted on ``sizes_from`` if given: cheaper, with at least the same rows.
    """
    kind = df.schema[ts].dataType
    rows = df.select(*keys, position(df, ts).alias("at"))
    counts = anchored_counts(rows, list(keys), micros(size), hot, sizes_from)
    return counts.select(
        *keys,
        from_position(F.col("anchor"), kind).alias("anchor"),
        from_position(F.col("anchor") + micros(size), kind).alias("fired_at"),
        "count",
    )


def event_timers(df: DataFrame, key: str, ts: str, delay: str | int = "9999 milliseconds") -> DataFrame:
    """One timer per key and time, however many rows asked for it, with the time it fires."""
    return df.select(key, ts).distinct().withColumn("fire_at", F.col(ts) + interval(delay))


def forward_with_timer(df: DataFrame, ts: str, delay: str | int = "10 seconds") -> DataFrame:
    """Every row as it is, with the time of the callback it schedules."""
    return df.withColumn("fire_at", F.col(ts) + interval(delay))


def login_failures(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    kind: str,
    within: str | int = "5 seconds",
    fail: str = "fail",
    success: str = "success",
    rearm: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Users with two failures inside ``within`` of the first, and no success before it is over.

    A success starts a new segment, and a segment alerts at most once, on its first failure. With
    ``rearm`` a failure after the wait is over starts another wait in the same segment.
    """
    ts = order[0]
    time_type = df.schema[ts].dataType
    at = position(df, ts)
    wait = micros(within)
    logins = df.filter(F.col(kind).isin(fail, success))
    failed = F.col(kind) == fail
    segments = Ordered(logins, [key], order, hot).running(
        _seg=running_sum(F.when(failed, 0).otherwise(1).cast("bigint")), _next=next_row(at)
    )
    if rearm:
        rows = segments.rows()
        ends = rows.groupBy(key, "_seg").agg(_end_of_run())
        fails = rows.filter(failed).select(key, "_seg", ts)
        waits = anchored_windows(fails, [key, "_seg"], ts, within, hot, logins).filter(F.col("count") >= 2)
        due = position(waits, "fired_at")
        found = waits.join(ends, [key, "_seg"]).filter(_not_ended(due))
        return found.select(key, F.col("fired_at").alias("alert_at"))
    runs = (
        segments.running(
            _before=latest(F.when(failed, F.struct(F.col("_seg").alias("seg"))), inclusive=False)
        )
        .rows()
        .groupBy(key, "_seg")
        .agg(
            F.min(F.when(failed, at)).alias("_first"),
            F.min(F.when(failed & (F.col("_before.seg") == F.col("_seg")), at)).alias("_second"),
            _end_of_run(),
        )
    )
    due = F.col("_first") + wait
    return runs.filter((F.col("_second") <= due) & _not_ended(due)).select(
        key, from_position(due, time_type).alias("alert_at")
    )


def order_timeouts(
    df: DataFrame,
    key: str,
    ts: str,
    kind: str,
    tie: str,
    within: str | int = "5 seconds",
    create: str = "create",
    pay: str = "pay",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Orders not paid within ``within`` of their creation, also for keys with repeated events.

    Every event sets a timer and every timer clears the state. So the events between two timers of
    a key decide alone: a timeout when there is a creation and no payment among them.
    """
    time_type = df.schema[ts].dataType
    moves = df.filter(F.col(kind).isin(create, pay)).select(
        key,
        F.col(tie).alias("_tie"),
        F.explode(
            F.array(
                F.struct(position(df, ts).alias("at"), F.lit(0).alias("rank"), F.col(kind).alias("kind")),
                F.struct(
                    (position(df, ts) + micros(within)).alias("at"),
                    F.lit(1).alias("rank"),
                    F.lit("timer").alias("kind"),
                ),
            )
        ).alias("_e"),
    )
    moves = moves.select(key, "_tie", F.col("_e.at").alias("_at"), F.col("_e.rank").alias("_rank"), F.col("_e.kind").alias("_kind"))
    turns = (
        Ordered(moves, [key], ["_at", "_rank", "_tie"], hot)
        .running(_turn=running_sum(F.col("_rank").cast("bigint"), inclusive=False))
        .rows()
        .groupBy(key, F.coalesce("_turn", F.lit(0)).alias("_turn"))
        .agg(
            F.min(F.when(F.col("_kind") == create, F.col("_at"))).alias("_created"),
            F.count(F.when(F.col("_kind") == pay, True)).alias("_paid"),
            F.max(F.when(F.col("_rank") == 1, F.col("_at"))).alias("_fired"),
        )
    )
    return turns.filter(F.col("_created").isNotNull() & (F.col("_paid") == 0)).select(
        key,
        from_position(F.col("_created"), time_type).alias("created_at"),
        from_position(F.col("_fired"), time_type).alias("timeout_at"),
    )
