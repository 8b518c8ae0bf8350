"""Waiting rows of streams lie in chunks: few calls to the state, whatever the rows, in order across overlapping chunks."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from tidemark.streaming import folds, processors


pytestmark = pytest.mark.usefixtures("spark")


class State(dict):
    """Value and map state of one key in memory; counts what it is asked."""

    def __init__(self, calls):
        self.calls = calls

    def __getattribute__(self, name):
        if name in ("getValue", "updateValue", "removeKey", "update", "get", "exists", "clear"):
            object.__getattribute__(self, "calls").append(name)
        return object.__getattribute__(self, name)

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]

    def update(self, value):
        self["value"] = value

    def get(self):
        return self["value"] if "value" in self else None

    def exists(self):
        return "value" in self


class Seen(folds.Fold):
    """Every row again, and how many were before it."""

    state, output, start = "n bigint", "at bigint, tie bigint, value bigint, n bigint", (0,)

    def row(self, state, move):
        return (state[0] + 1,), [(move.at, move.tie, move.value, state[0])]


def run(batches):
    """All rows that come out when each batch (moves, watermark) is followed by its timers, and the calls to the state."""
    calls, timers = [], set()
    state = State(calls), State(calls), State(calls)
    handle = SimpleNamespace(
        getValueState=lambda name, _: state[0] if name == "machine" else state[1],
        getMapState=lambda *_: state[2],
        registerTimer=timers.add,
    )
    schema = T.StructType.fromDDL("k int, _at bigint, _tie bigint, _value bigint")
    machine = processors.InOrder(Seen(), Seen.state, schema, ["k", "at", "tie", "value", "n"], slot=None)
    machine.init(handle)
    make, out = Row(*schema.names), []
    for moves, mark in batches:
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda mark=mark: mark)
        if moves:
            machine.handleInputRows((1,), iter([make(1, *m) for m in moves]), clock)
        for due in sorted(t for t in timers if t <= mark):
            timers.discard(due)
            out += machine.handleExpiredTimer((1,), clock, None)
    return out, calls, state


def test_a_key_costs_calls_by_chunk_and_not_by_row():
    day = 24 * 3600 * 1_000_000
    _, few, _ = run([([(i * day // 50, i, i) for i in range(50)], -1), ([], 10**9)])
    out, many, _ = run([([(i * day // 50, i, i) for i in range(900)], -1), ([], 10**10)])
    assert len(out) == 900 and len(many) == len(few) <= 10


@pytest.mark.parametrize("chunk, held", [(1, 4), (3, 7), (8, 1000)])
def test_overlapping_chunks_come_in_order(monkeypatch, chunk, held):
    monkeypatch.setattr(processors, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(processors, "HELD_ROWS", held)
    rng, batches, mark, sent = random.Random(chunk), [], 0, 0
    for _ in range(30):
        moves = [(1000 * (mark + rng.randrange(1, 40)), rng.choice([None, 1, 2]), sent + i) for i in range(rng.randrange(12))]
        sent += len(moves)
        mark += rng.randrange(9)
        batches.append((moves, mark))
    out, _, state = run([*batches, ([], mark + 100)])
    whole = folds.in_order(folds.Move(*m) for moves, _ in batches for m in moves)
    assert [r[1:] for r in out] == [(m.at, m.tie, m.value, i) for i, m in enumerate(whole)]
    assert not state[2] and len(whole) == sent


def test_a_row_goes_back_a_few_times_only():
    """A watermark that passes a row at a time: the rest of a chunk is halved, not written whole again."""
    n = 512
    _, calls, _ = run([([(i * 1000, i, i) for i in range(n)], -1), *(([], i) for i in range(n))])
    assert calls.count("updateValue") <= 2 * n
