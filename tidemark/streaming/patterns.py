"""Event patterns on streams: the patterns of ``operators.patterns``, with the events of their steps.

Catalyst computes every step's condition, as one bit of a number per row; what is left for the state
machine is to follow bits in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.patterns import Pattern
from tidemark.streaming.folds import PatternMatch
from tidemark.streaming.processors import run_fold


def match(rows: DataFrame, pattern: Pattern, key: str, ts: str, tie: str, timeouts: bool = False) -> DataFrame:
    """Matches of a stream with a watermark on ``ts``: the same columns as the batch form gives.

    A match is out when the watermark passes its last event, a timeout when it passes the end of the wait; a
    pattern without a bound has no timeouts here, as a stream never says that no event will follow.
    """
    event = F.struct(*[F.col(c) for c in rows.columns if c != key])
    if pattern.repeats is not None:
        # Not a filter: Spark would move it below the watermark, which then only the events of the pattern would raise.
        name, where = pattern.steps[0]
        names = [f"{name}_{i + 1}" for i in range(pattern.repeats)]
        mask = F.when(where, F.lit(2 ** len(names) - 1)).otherwise(F.lit(0)).cast("bigint")
        event = F.when(where, event)
    else:
        names = [name for name, _ in pattern.steps]
        bits = [F.when(where, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, (_, where) in enumerate(pattern.steps)]
        mask = sum(bits[1:], bits[0])
    fold = PatternMatch(len(names), pattern.bound, timeouts, gaps=pattern.repeats is not None)
    found = run_fold(rows, fold, key, ts, tie, value=mask, event=event)
    return found.select(key, *[F.get("events", F.lit(i)).alias(n) for i, n in enumerate(names)], "output")
