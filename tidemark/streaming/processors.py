"""The state machines of ``folds`` as ``transformWithState`` operators.

Spark hands over a key's rows of one micro-batch unsorted, and fires timers after them. So rows
are kept in state until the watermark has passed them, then fed in order together with the
machine's own timers: late arrivals within the watermark's delay take their right place.

Waiting rows lie in the state in chunks, cut from a batch's rows in order. A call to the state costs more than the
rows of a chunk, so a key costs a few calls per batch and chunk, none per row. What the watermark passes is read and
removed chunk by chunk, the rest of a chunk goes back in halves: a row is written at most as often as a chunk can be
halved, however many wait, and a key's work grows with its rows, not with their square. Values and events keep their
types, NULLs included.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from itertools import groupby, islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.plans.durations import micros, position
from tidemark.session import use_rocksdb
from tidemark.streaming.folds import Fold, Move, advance, in_order

#: Rows of a key that are held and sorted before they are written, and rows of a chunk.
HELD_ROWS, CHUNK_ROWS = 50_000, 1_000
EPOCH, MICROSECOND = datetime(1970, 1, 1, tzinfo=UTC), timedelta(microseconds=1)


def _plain(value, kind: T.DataType):
    """Structs as tuples, all the way down: what the machines keep and what state takes. Spark hands them over as rows or dicts."""
    if value is None:
        return None
    match kind:
        case T.StructType():
            found = [value[f.name] for f in kind] if isinstance(value, dict) else value
            return tuple(_plain(v, f.dataType) for v, f in zip(found, kind))
        case T.ArrayType():
            return [_plain(v, kind.elementType) for v in value]
        case _:
            return value


def _reader(name: str, kind: T.DataType):
    """How a field of a move is read from a row; None where it is as it should be already."""
    if name == "_at" and isinstance(kind, T.TimestampType):
        return lambda at: (at - EPOCH) // MICROSECOND

    def nested(k: T.DataType) -> bool:
        return isinstance(k, T.StructType) or isinstance(k, T.ArrayType) and nested(k.elementType)

    return (lambda value: _plain(value, kind)) if nested(kind) else None


class _Machine(StatefulProcessor):
    """A machine's state, and its results as rows."""

    def __init__(self, fold: Fold, state: str, rows: T.StructType, names: list[str]):
        self.fold, self.names = fold, names
        self.state_kind = T.StructType.fromDDL(state)
        #: Where a row holds the fields of a move, and how to read them.
        places = {name: i for i, name in enumerate(rows.names)}
        fields = [f"_{name}" for name in Move._fields]
        self.fields = [(places[f], _reader(f, rows[f].dataType)) if f in places else None for f in fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", self.state_kind)
        self.row = Row(*self.names)

    def _move(self, row: Row) -> Move:
        return Move(*[None if f is None else row[f[0]] if f[1] is None else f[1](row[f[0]]) for f in self.fields])

    def _advance(self, key: tuple, blocks: Iterator[list[Move]], until: int) -> Iterator[Row]:
        """Feed the machine block by block, then fire its timers; what it finds as rows, and the time of its next timer kept."""
        before = self.machine.get()
        state = self.fold.start if before is None else _plain(before, self.state_kind)
        for moves in blocks:
            # Timers before a block's last row have fired by then; those at its time come after rows still to come.
            state, found = advance(self.fold, state, moves, moves[-1].at - 1)
            yield from self._rows(key, found)
        state, found = advance(self.fold, state, [], until)
        yield from self._rows(key, found)
        if state != self.fold.start:
            self.machine.update(state)
        elif before is not None:
            self.machine.clear()
        self.due = self.fold.due(state)

    def _rows(self, key: tuple, found: list[tuple]) -> Iterator[Row]:
        row = self.row
        return (row(*key, *values) for values in found)

    def close(self) -> None:
        pass


class InOrder(_Machine):
    """Keep rows in chunks by time, and feed those up to the watermark to the machine in order.

    A chunk holds rows that follow each other in one sorted part of a key's rows. It lies under its first time,
    the number of the part and the place of its first row there, and its rows are packed into bytes, which keeps
    Python's values as they are and takes Spark no work per row.
    """

    def __init__(self, *args, slot: int | None):
        super().__init__(*args)
        self.slot = slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "first bigint, part bigint, place bigint", "moves binary")
        self.parts = handle.getValueState("parts", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        part, first = (self.parts.get() or (0,))[0], None
        moves = (self._move(row) for row in rows)
        while held := in_order(islice(moves, HELD_ROWS)):
            place = 0
            for _, slot in groupby(held, lambda m: m.at // self.slot if self.slot else 0):
                while chunk := list(islice(slot, CHUNK_ROWS)):
                    self._keep(chunk, part, place)
                    place += len(chunk)
            first = held[0].at if first is None else min(first, held[0].at)
            part += 1
        self.parts.update((part,))
        self._wake_at(first)
        return iter(())

    def _keep(self, moves: list[Move], part: int, place: int) -> None:
        self.waiting.updateValue((moves[0].at, part, place), (pickle.dumps([tuple(m) for m in moves]),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        chunks = sorted(tuple(k) for k in self.waiting.keys())
        ready = sum(first <= passed for first, _, _ in chunks)
        self.wakes = [chunks[ready][0]] if ready < len(chunks) else []
        yield from self._advance(key, self._passed(chunks[: ready + 1], ready, passed), passed)
        if self.wakes:
            self._wake_at(min(self.wakes))
        else:
            self.parts.clear()
        if self.due is not None:
            self._wake_at(self.due)

    def _passed(self, chunks: list[tuple], ready: int, passed: int) -> Iterator[list[Move]]:
        """The rows up to ``passed`` in order, a block per chunk; only chunks that overlap are in memory together.

        Equal rows stay as they came: by part, then by place in it.
        """
        held: list[tuple] = []
        for i in range(ready):
            first, part, place = chunks[i]
            moves = [Move(*m) for m in pickle.loads(self.waiting.getValue(chunks[i])[0])]
            self.waiting.removeKey(chunks[i])
            n = len(moves) if moves[-1].at <= passed else sum(m.at <= passed for m in moves)
            rest = moves[n:]
            half = -(-len(rest) // 2)
            for at in (0, half):
                if rest[at : at + half]:
                    self._keep(rest[at : at + half], part, place + n + at)
            if rest:
                self.wakes.append(rest[0].at)
            held += [(m.at, m.tie is not None, m.tie or 0, part, place + j, m) for j, m in enumerate(moves[:n])]
            held.sort()
            until = chunks[i + 1][0] if i + 1 < ready else passed + 1
            n = len(held) if held[-1][0] < until else sum(h[0] < until for h in held)
            if n:
                yield [h[-1] for h in held[:n]]
                del held[:n]

    def _wake_at(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))


class OnArrival(_Machine):
    """Feed rows as they come; times and timers are those of the processing clock."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        return self._after(key, in_order(self._move(r)._replace(at=now) for r in rows), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._after(key, [], timerValues.getCurrentProcessingTimeInMs() * 1000)

    def _after(self, key: tuple, moves: list[Move], now: int) -> Iterator[Row]:
        yield from self._advance(key, [moves] if moves else [], now)
        if self.due is not None:
            self.handle.registerTimer(max(-(-self.due // 1000), now // 1000 + 1))


def _moves(rows: DataFrame, key: str, ts: str | None, tie: str, value: Column | None, kind: Column | None, event: Column | None):
    """Rows of the key, the event time and the fields of a move, with the types of values and events.

    Python takes every cell of a row apart, so what is not given is no column, and a timestamp is not there twice.
    """
    at = []
    if ts is not None:
        zoned = isinstance(rows.schema[ts].dataType, T.TimestampType)
        at = [F.col(ts).alias("_at")] if zoned else [ts, position(rows, ts).alias("_at")]
    given = {"_value": value, "_kind": None if kind is None else kind.cast("string"), "_event": event}
    moves = rows.select(key, *at, F.col(tie).cast("bigint").alias("_tie"), *[c.alias(f) for f, c in given.items() if c is not None])
    kinds = {f.name: f.dataType.simpleString() for f in moves.schema}
    return moves, {"value": kinds.get("_value", "double"), "event": kinds.get("_event", "boolean")}


def _run(kind: type[_Machine], moves: DataFrame, types: dict[str, str], fold: Fold, key: str, mode: str, **more) -> DataFrame:
    use_rocksdb(moves.sparkSession)
    output = T.StructType([moves.schema[key], *T.StructType.fromDDL(fold.output.format(**types)).fields])
    return moves.groupBy(key).transformWithState(
        statefulProcessor=kind(fold, fold.state.format(**types), moves.schema, output.fieldNames(), **more),
        outputStructType=output,
        outputMode="Append",
        timeMode=mode,
    )


def run_fold(
    rows: DataFrame,
    fold: Fold,
    key: str,
    ts: str,
    tie: str,
    value: Column | None = None,
    kind: Column | None = None,
    event: Column | None = None,
    slot: str | int | None = None,
) -> DataFrame:
    """The machine's output per key; ``rows`` is a stream with a watermark on ``ts``.

    ``value`` and ``event`` may be of any type; ``event`` is what machines with events give back. Waiting
    rows are kept in chunks of bounded length, which with ``slot`` also end at multiples of it.
    """
    moves, types = _moves(rows, key, ts, tie, value, kind, event)
    return _run(InOrder, moves, types, fold, key, "EventTime", slot=None if slot is None else micros(slot))


def run_on_arrival(
    rows: DataFrame,
    fold: Fold,
    key: str,
    tie: str,
    value: Column | None = None,
    kind: Column | None = None,
    event: Column | None = None,
) -> DataFrame:
    """The machine's output per key by the processing clock: a row's time is when its batch runs.

    Rows of a batch go in by tie-break. Timers fire at their time also when no rows come.
    """
    moves, types = _moves(rows, key, None, tie, value, kind, event)
    return _run(OnArrival, moves, types, fold, key, "ProcessingTime")
