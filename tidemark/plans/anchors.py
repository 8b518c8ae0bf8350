"""Windows anchored at the first row after the last window closed.

Where a window opens depends on where the one before did, so a key is walked in order. The walk
runs over the Arrow batches of sorted partitions and holds one open window, whatever the size of a
key. A hot key is cut in pieces of rows. All a piece needs from the ones before is when the last
window closes, so each piece is first reduced to a step function, from that time to the last anchor of the
piece, in one scan: one path for every time at which the first window may open, and paths that meet are one
from then on. Only times in the first window length of a piece can open its first window, so a scan holds
the times of one window, however long the piece is.

The functions of a key are followed in order, and the walk starts each piece from the right place. When there
are too many for one task, the functions of ``FAN_IN`` neighbouring tasks are composed to one, those are followed
first, and then each block is followed from where it starts. A composed function has the times of one window, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import PIECE, ROW_BITS, HotKeys, Ordered
from tidemark.session import written

#: Bits of a piece number that one level of blocks takes together.
FAN_BITS = 6
LEVELS = (63 - ROW_BITS) // FAN_BITS


def anchored_counts(
    df: DataFrame, keys: list[str], size: int, hot: HotKeys | None = None, sizes_from: DataFrame | None = None
) -> DataFrame:
    """keys, anchor and count, from rows with keys and ``at`` (bigint microseconds).

    Key sizes are counted on ``sizes_from`` if given, as ``Ordered`` does.
    """
    ordered = Ordered(df.select(*keys, "at"), keys, ["at"], hot, sizes_from)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    if not ordered.cut:
        rows = ordered.df.select(*keys, F.lit(None).cast("bigint").alias("_entry"), "at")
        return _sorted(rows, keys, ["at"]).mapInArrow(_walker(keys, keys, size), f"{kinds}, anchor bigint, count bigint")
    pieces, by = ordered.df, [*keys, PIECE]
    hot_rows = pieces.filter(F.col(PIECE).isNotNull())
    steps = _sorted(hot_rows.select(*by, "at"), by, ["at"]).mapInArrow(_reducer(by, size), f"{kinds}, {PIECE} bigint, until bigint, leaves bigint")
    entries = _entries(written(steps, "anchor-steps"), keys, kinds, size, ordered.hot.of_pieces().hot_rows, 1)
    renamed = entries.select(*[F.col(c).alias(f"_of_{c}") for c in by], "_entry")
    cond = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    started = pieces.join(renamed, cond, "left").select(*by, "_entry", "at")
    walked = _sorted(started, by, ["at"]).mapInArrow(_walker(by, keys, size), f"{kinds}, anchor bigint, count bigint")
    return walked.groupBy(*keys, "anchor").agg(F.sum("count").alias("count"))


def _sorted(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by, *order)


def _runs(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Values and bounds of consecutive equal rows; the batch is sorted by these columns."""
    if not batch.num_rows:
        return
    ends = np.unique(np.concatenate([pc.run_end_encode(batch.column(c)).run_ends.to_numpy() for c in by]))
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        yield tuple(batch.column(c)[a].as_py() for c in by), a, b


def _batch(schema: pa.Schema, keys: list[str], rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of key values and bigints, the keys in the type they came in."""
    columns = list(zip(*rows)) or [()] * (len(keys) + len(names))
    kinds = [schema.field(k).type for k in keys] + [pa.int64()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*keys, *names])


def _walker(by: list[str], keys: list[str], size: int):
    """Windows and their rows, by group of sorted rows (``by``, ``_entry``, ``at``); ``keys`` are the first of ``by``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, anchor, count, schema = None, None, 0, None
        for batch in batches:
            done, schema = [], batch.schema
            times = batch.column("at").to_numpy()
            for values, a, b in _runs(batch, by):
                if values != group:
                    if count:
                        done.append((*group[: len(keys)], anchor, count))
                    group, anchor, count = values, batch.column("_entry")[a].as_py(), 0
                while a < b:
                    if anchor is None or times[a] > anchor + size:
                        if count:
                            done.append((*group[: len(keys)], anchor, count))
                        anchor, count = int(times[a]), 0
                    end = a + int(np.searchsorted(times[a:b], anchor + size, side="right"))
                    count += end - a
                    a = end
            yield _batch(schema, keys, done, ["anchor", "count"])
        if count:
            yield _batch(schema, keys, [(*group[: len(keys)], anchor, count)], ["anchor", "count"])

    return walk


class Steps:
    """A step function: a window that closes before ``until`` (and not before the one above's) ends in ``leaves``.

    One that closes at the last ``until`` or later is still the last window after these rows.
    """

    def __init__(self, until: np.ndarray, leaves: np.ndarray):
        last = np.append(leaves[1:] != leaves[:-1], True)[: len(leaves)]
        self.until, self.leaves = until[last], leaves[last]

    def after(self, anchors: np.ndarray, size: int) -> np.ndarray:
        """The last anchors after these rows, from those before."""
        at = np.searchsorted(self.until, anchors + size, side="right")
        inside = at < len(self.until)
        return np.where(inside, self.leaves[np.where(inside, at, 0)], anchors) if len(self.until) else anchors

    def then(self, other: Steps, size: int) -> Steps:
        """These rows and then the others. No window before them closes later than ``size`` after the first."""
        more = other.until > self.until[-1]
        until = np.append(self.until, other.until[more])
        leaves = np.append(other.after(self.leaves, size), other.leaves[more])
        needed = int(np.searchsorted(until, until[0] + size, side="right")) + 1
        return Steps(until[:needed], leaves[:needed])


class Scan:
    """The step function of rows that come in order, some at a time. Holds a path per opening time still apart."""

    def __init__(self, size: int):
        self.size, self.first, self.filling = size, None, True
        self.steps = Steps(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def feed(self, times: np.ndarray) -> None:
        times = np.unique(times)
        after = np.searchsorted(times, times + self.size, side="right")
        path = np.where(after < len(times), after, np.arange(len(times)))
        while not np.array_equal(longer := path[path], path):
            path = longer
        within = Steps(times, times[path])
        until, leaves = self.steps.until, within.after(self.steps.leaves, self.size)
        if self.first is None:
            self.first = times[0]
        if self.filling:
            opens = int(np.searchsorted(times, self.first + self.size, side="right")) + 1
            self.filling = opens > len(times)
            until, leaves = np.append(until, times[:opens]), np.append(leaves, times[path[:opens]])
        self.steps = Steps(until, leaves)


def _reducer(by: list[str], size: int):
    """The step function of every group of sorted rows (``by``, ``at``)."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, scan, schema = None, None, None
        for batch in batches:
            schema, times = batch.schema, batch.column("at").to_numpy()
            for values, a, b in _runs(batch, by):
                if values != group:
                    if scan:
                        yield _function(schema, by, group, scan.steps)
                    group, scan = values, Scan(size)
                scan.feed(times[a:b])
        if scan:
            yield _function(schema, by, group, scan.steps)

    return reduce


def _function(schema: pa.Schema, by: list[str], group: tuple, steps: Steps) -> pa.RecordBatch:
    keys = [pa.array([v] * len(steps.until), schema.field(c).type) for c, v in zip(by, group)]
    return pa.RecordBatch.from_arrays([*keys, pa.array(steps.until), pa.array(steps.leaves)], [*by, "until", "leaves"])


def _functions(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.RecordBatch, int, tuple, Steps]]:
    """Every group's step function from rows sorted by (``by``, ``until``), with a batch and place of one of its rows."""
    group, held, where = None, [], None
    for batch in batches:
        until, leaves = batch.column("until").to_numpy(), batch.column("leaves").to_numpy()
        for values, a, b in _runs(batch, by):
            if values != group and held:
                yield *where, group, _joined(held)
                held = []
            group, where = values, (batch, a)
            held.append((until[a:b], leaves[a:b]))
    if held:
        yield *where, group, _joined(held)


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> Steps:
    return Steps(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))


def _entries(steps: DataFrame, keys: list[str], kinds: str, size: int, most: int, level: int) -> DataFrame:
    """(keys, piece, _entry): the last anchor before each piece; blocks of pieces first where there are more than ``most`` steps."""
    block = F.shiftright(PIECE, ROW_BITS + FAN_BITS * level) if level <= LEVELS else F.lit(0).cast("bigint")
    if level > LEVELS or steps.count() <= most:
        started = steps.select(*keys, F.lit(0).cast("bigint").alias("_block"), PIECE, "until", "leaves", F.lit(None).cast("bigint").alias("_start"))
    else:
        by = [*keys, "_block"]
        blocked = steps.withColumn("_block", block)
        composed = _sorted(blocked, by, [PIECE, "until"]).mapInArrow(_composer(by, size), f"{kinds}, _block bigint, until bigint, leaves bigint")
        numbered = composed.withColumn(PIECE, F.shiftleft("_block", ROW_BITS + FAN_BITS * level)).drop("_block")
        above = _entries(written(numbered, "anchor-steps"), keys, kinds, size, most, level + 1)
        of = {**{k: f"_of_{k}" for k in keys}, PIECE: "_of_block"}
        above = above.select(*[F.col(c).alias(n) for c, n in of.items()], F.col("_entry").alias("_start"))
        cond = [F.col(k).eqNullSafe(F.col(of[k])) for k in keys]
        cond.append(F.shiftleft("_block", ROW_BITS + FAN_BITS * level) == F.col("_of_block"))
        started = blocked.join(above, cond, "left").select(*by, PIECE, "until", "leaves", "_start")
    by = [*keys, "_block"]
    return _sorted(started, by, [PIECE, "until"]).mapInArrow(_follower(by, keys, size), f"{kinds}, {PIECE} bigint, _entry bigint")


def _composer(by: list[str], size: int):
    """One step function for each block of pieces."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, all_of_it, schema = None, None, None
        for batch, _, group, steps in _functions(batches, [*by, PIECE]):
            schema = batch.schema
            if group[:-1] != block:
                if all_of_it:
                    yield _function(schema, by, block, all_of_it)
                block, all_of_it = group[:-1], steps
            else:
                all_of_it = all_of_it.then(steps, size)
        if all_of_it:
            yield _function(schema, by, block, all_of_it)

    return compose


def _follower(by: list[str], keys: list[str], size: int):
    """The last anchor before each piece, following the pieces of a block from its ``_start``."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchor = None, None
        for batch, at, group, steps in _functions(batches, [*by, PIECE]):
            if group[:-1] != block:
                block, anchor = group[:-1], batch.column("_start")[at].as_py()
            yield _batch(batch.schema, keys, [(*group[: len(keys)], group[-1], anchor)], [PIECE, "_entry"])
            anchor = int(steps.leaves[0] if anchor is None else steps.after(np.array([anchor]), size)[0])

    return follow
