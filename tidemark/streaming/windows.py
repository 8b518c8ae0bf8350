"""Windows on streams that fire when their time comes and again for records that come late."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.durations import floor_to, from_position, micros, position
from tidemark.session import use_rocksdb


class LateUpdates(StatefulProcessor):
    """The records of one (keys, window) counted; ``ahead`` is how far the effective watermark is before Spark's."""

    def __init__(self, names: list[str], ahead: int, lateness: int):
        self.names, self.ahead, self.lateness = names, ahead, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end, mark = key[-1], timerValues.getCurrentWatermarkInMs() * 1000
        # Spark's watermark is zero until a batch has raised it.
        open_ = mark <= 0 or end > mark + self.ahead
        if not open_ and end <= mark + self.ahead - self.lateness:
            return
        n, fired = self.seen.get() if self.seen.exists() else (0, False)
        if open_:
            n += sum(1 for _ in rows)
            self.handle.registerTimer(self._fires(end))
        else:
            # Timers of a batch run after its records: the window's own firing goes first.
            if n and not fired:
                yield self._row(key, None, False, n)
            fired = True
            for tie in sorted((r.tie for r in rows), key=lambda t: (t is not None, t or 0)):
                n += 1
                yield self._row(key, tie, n > 1, n)
        self.seen.update((n, fired))
        self.handle.registerTimer(self._closes(end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.seen.exists():
            return
        n, fired = self.seen.get()
        if not fired:
            yield self._row(key, None, False, n)
            self.seen.update((n, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= self._closes(key[-1]):
            self.seen.clear()

    def _fires(self, end: int) -> int:
        return -(-(end - self.ahead) // 1000)

    def _closes(self, end: int) -> int:
        return -(-(end - self.ahead + self.lateness) // 1000)

    def _row(self, key: tuple, tie: int | None, is_update: bool, n: int) -> Row:
        return Row(**dict(zip(self.names, (*key, tie, is_update, n), strict=True)))

    def close(self) -> None:
        pass


def late_updates(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    size: str | int = "5 seconds",
    delay: str | int = "5 seconds",
    lateness: str | int = "5 seconds",
) -> DataFrame:
    """What windows with allowed lateness emit: a count when they close, then one per late record.

    The columns are those of ``late.updating_windows``: ``fired_by`` is the tie-break of the late record, NULL for
    the window's own firing; ``is_update`` is false for a window's first row. The watermark of a micro-batch is
    the largest event time of the batches before it minus ``delay``; records of a batch count by tie-break, and one is
    dropped when its window closed ``lateness`` or more before that. ``rows`` has event times as timestamps
    and no watermark yet. A window's state is two values, kept until no record can change it.
    """
    use_rocksdb(rows.sparkSession)
    long, late = micros(size), micros(lateness)
    # Spark drops records by their own times, windows close by their ends: a window's length is between the two.
    ahead = long + late
    moves = rows.withWatermark(ts, f"{micros(delay) + ahead} microseconds").select(
        *keys, ts, (floor_to(position(rows, ts), long) + long).alias("window_end"), F.col(tie).cast("bigint").alias("tie")
    )
    found = T.StructType.fromDDL("fired_by bigint, is_update boolean, count bigint")
    output = T.StructType([*[moves.schema[k] for k in (*keys, "window_end")], *found.fields])
    fired = moves.groupBy(*keys, "window_end").transformWithState(
        statefulProcessor=LateUpdates(output.fieldNames(), ahead, late),
        outputStructType=output,
        outputMode="Append",
        timeMode="EventTime",
    )
    return fired.withColumn("window_end", from_position(F.col("window_end"), T.TimestampType()))
