"""Joins and two-input operators on keys and event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durations import from_position, micros, position
from tidemark.plans.ordered import HotKeys, Ordered, latest, running_max
from tidemark.plans.ranges import left_bucket, range_join, right_buckets


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str | int = "-5 seconds",
    upper: str | int = "5 seconds",
) -> DataFrame:
    """All pairs of a key whose right time is within [left + lower, left + upper], both inclusive."""
    return range_join(left, right, keys, left_ts, right_ts, lower, upper)


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    size: str | int = "5 seconds",
) -> DataFrame:
    """All pairs of a key that fall in the same tumbling window.

    The window is part of the equi key, and adaptive execution splits a hot (key, window).
    """
    span = f"{micros(size)} microseconds"
    a = left.withColumn("window_start", F.window(left_ts, span)["start"])
    b = right.withColumn("window_start", F.window(right_ts, span)["start"])
    return a.join(b, [*keys, "window_start"])


def two_input_watermark(
    rows: DataFrame,
    source: str,
    order: Sequence[str],
    ts: str,
    delays: tuple[str | int, str | int],
    hot: HotKeys | None = None,
) -> DataFrame:
    """The watermark each record of two merged inputs meets: the smaller of the two.

    Each input's watermark is its largest event time so far minus its delay; there is no combined
    one until both inputs have sent something.
    """
    kind = rows.schema[ts].dataType
    pos = position(rows, ts)
    seen = Ordered(rows, [], order, hot).running(
        _first=running_max(F.when(F.col(source) == 1, pos - micros(delays[0])), inclusive=False),
        _second=running_max(F.when(F.col(source) == 2, pos - micros(delays[1])), inclusive=False),
    )
    both = F.when(
        F.col("_first").isNotNull() & F.col("_second").isNotNull(), F.least("_first", "_second")
    )
    named = {"first_watermark": F.col("_first"), "second_watermark": F.col("_second"), "watermark": both}
    return (
        seen.rows()
        .withColumns({n: from_position(c, kind) for n, c in named.items()})
        .drop("_first", "_second")
    )


def switch_filter(
    readings: DataFrame,
    switches: DataFrame,
    key: str,
    ts: str,
    duration: str,
    tie: str,
    first_timer_wins: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Readings of a key while a switch has it enabled, for ``duration`` microseconds from the switch.

    ``switches`` has the key, the time and the duration. By default a reading passes when it is in
    the closed interval of any switch: the running maximum of the interval ends decides, so no
    pairs are formed. With ``first_timer_wins`` the end of any interval disables the key, also when
    a later switch is still running. A switch sorts before a reading of the same time, an end after.
    """
    kind = readings.schema[ts].dataType
    start = position(switches, ts)
    plain = readings.withColumns(
        {"_at": position(readings, ts), "_rank": F.lit(1), "_end": F.lit(None).cast("bigint"),
         "_on": F.lit(None).cast("boolean")}
    )
    control = switches.select(key, start.alias("_at"), F.lit(0).alias("_rank"), (start + F.col(duration)).alias("_end"))
    if first_timer_wins:
        control = control.select(
            key,
            F.explode(
                F.array(
                    F.struct(F.col("_at"), F.lit(0).alias("_rank"), F.lit(True).alias("_on")),
                    F.struct(F.col("_end").alias("_at"), F.lit(2).alias("_rank"), F.lit(False).alias("_on")),
                )
            ).alias("_e"),
        ).select(key, "_e.*")
    merged = plain.unionByName(control, allowMissingColumns=True).withColumn(
        tie, F.coalesce(F.col(tie), F.lit(-1).cast("bigint"))
    )
    ordered = Ordered(merged, [key], ["_at", "_rank", tie], hot)
    if first_timer_wins:
        passed = ordered.running(_state=latest(F.col("_on"))).rows().filter("_rank = 1 AND _state")
    else:
        passed = ordered.running(_state=running_max(F.col("_end"))).rows().filter("_rank = 1 AND _at <= _state")
    return passed.withColumn(ts, from_position(F.col("_at"), kind)).select(*readings.columns)


def reconcile(
    orders: DataFrame,
    pays: DataFrame,
    key: str,
    order_ts: str,
    pay_ts: str,
    patience: str | int = "5 seconds",
) -> DataFrame:
    """Orders against payments: ``matched`` pairs, ``unmatched_order`` and ``unmatched_pay``.

    Two records of a key match when they are at most ``patience`` apart. Pairs come from one inner join on the
    key and a time bucket: an order is in one bucket with all its possible payments, so each pair comes once, and
    adaptive execution may split a hot (key, bucket) on either side. Whether a record matched is decided by
    its key and time alone, so those of the pairs, each once, rule records out by an anti join, of which the records'
    side may be split. A NULL key or time matches nothing.
    """
    wait = micros(patience)
    order_type, pay_type = orders.schema[order_ts].dataType, pays.schema[pay_ts].dataType
    left = orders.select(key, position(orders, order_ts).alias("_order_at"))
    right = pays.select(key, position(pays, pay_ts).alias("_pay_at"))
    bucketed = left.withColumn("_bucket", left_bucket(F.col("_order_at"), -wait, wait))
    copied = right.withColumn("_bucket", F.explode(right_buckets(F.col("_pay_at"), -wait, wait)))
    near = (F.col("_pay_at") - F.col("_order_at")).between(-wait, wait)
    pairs = bucketed.join(copied, [key, "_bucket"]).filter(near).select(key, "_order_at", "_pay_at")
    none = F.lit(None).cast("bigint")
    found = [pairs.withColumn("output", F.lit("matched"))]
    for rows, at, output in ((left, "_order_at", "unmatched_order"), (right, "_pay_at", "unmatched_pay")):
        matched = pairs.select(F.col(key).alias("_key"), F.col(at).alias("_at")).distinct()
        alone = rows.join(matched, (F.col(key) == F.col("_key")) & (F.col(at) == F.col("_at")), "left_anti")
        found.append(alone.select(key, *[F.col(c) if c == at else none.alias(c) for c in ("_order_at", "_pay_at")], F.lit(output).alias("output")))
    return found[0].unionByName(found[1]).unionByName(found[2]).select(
        key,
        from_position(F.col("_order_at"), order_type).alias("order_at"),
        from_position(F.col("_pay_at"), pay_type).alias("pay_at"),
        "output",
    )
