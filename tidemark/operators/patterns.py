"""Event patterns: a start, strict successors, repetition and a time bound.

A pattern becomes one look-ahead column per step over the key's ordered rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durations import micros, position
from tidemark.plans.ordered import HotKeys, Ordered


@dataclass(frozen=True)
class Pattern:
    """Steps of (name, condition); built with ``begin``, ``next``, ``times`` and ``within``."""

    steps: tuple[tuple[str, Column], ...]
    repeats: int | None = None
    bound: int | None = None

    @staticmethod
    def begin(name: str, where: Column) -> Pattern:
        """The first event."""
        return Pattern(((name, where),))

    def next(self, name: str, where: Column) -> Pattern:
        """The very next event of the key."""
        return replace(self, steps=(*self.steps, (name, where)))

    def times(self, n: int) -> Pattern:
        """The one event of the pattern, ``n`` times, whatever lies between."""
        if len(self.steps) != 1:
            raise ValueError("times() is for a pattern of one step")
        return replace(self, repeats=n)

    def within(self, duration: str | int) -> Pattern:
        """The last event strictly less than ``duration`` after the first."""
        return replace(self, bound=micros(duration))


def match(
    df: DataFrame,
    pattern: Pattern,
    key: str,
    order: Sequence[str],
    timeouts: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Matches: the key, a struct of each step's event, and ``output``.

    ``output`` is ``matched``, or ``timeout`` for a begun match whose next event came too late or
    not at all, if ``timeouts`` are asked for; the steps it did not reach are NULL. A repeated
    step gives ``name_1`` to ``name_n``, one match from every possible start.
    """
    event = F.struct(*[F.col(c) for c in df.columns if c != key])
    if pattern.repeats is not None:
        name, where = pattern.steps[0]
        names = [f"{name}_{i + 1}" for i in range(pattern.repeats)]
        rows, wheres = df.filter(where), [F.lit(True)] * pattern.repeats
    else:
        names = [name for name, _ in pattern.steps]
        rows, wheres = df, [where for _, where in pattern.steps]
    flags = {f"_is_{i}": F.coalesce(w, F.lit(False)) for i, w in enumerate(wheres)}
    at = position(df, order[0])
    seen = Ordered(rows, [key], order, hot).with_columns(
        {**flags, "_0": F.struct(at.alias("at"), event.alias("event"), *[f for f in _named(flags)])}
    )
    if len(names) > 1:
        seen = seen.ahead(F.col("_0"), len(names) - 1)

    start = F.col("_0.at")
    reached, verdict = F.col("_0._is_0"), None
    in_time = []
    for i in range(1, len(names)):
        there = F.col(f"_{i}").isNotNull()
        if pattern.bound is not None:
            there = there & (F.col(f"_{i}.at") - start < pattern.bound)
        in_time.append((reached, there))
        reached = reached & there & F.col(f"_{i}._is_{i}")
    verdict = F.when(reached, "matched")
    if timeouts:
        for before, there in in_time:
            verdict = verdict.when(before & ~there, "timeout")
    rows = seen.with_columns({"output": verdict}).rows().filter(F.col("output").isNotNull())
    shown = [F.col("_0.event").alias(names[0])]
    for i in range(1, len(names)):
        got = in_time[i - 1][0] & in_time[i - 1][1]
        shown.append(F.when(got, F.col(f"_{i}.event")).alias(names[i]))
    return rows.select(key, *shown, "output")


def _named(flags: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in flags.items()]
