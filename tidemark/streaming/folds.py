"""Keyed state machines as pure steps: what a row does, and what a timer does.

A step takes a state tuple and gives the next one with output tuples. ``advance`` feeds rows in
order and fires each timer after the rows up to its time and before later ones, so a machine gives
the same result over a sorted list as over a stream. Times are bigint microseconds.

``state`` and ``output`` are schemas in which ``{value}`` stands for the type of the rows' values and
``{event}`` for that of whole events, so ids and decimals keep their type. Machines that take ``events=True``
give the events behind a result as well.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any, NamedTuple


class Move(NamedTuple):
    """What the machines see of a row."""

    at: int
    tie: int | None
    value: Any = None
    kind: str | None = None
    event: Any = None


def in_order(moves: Iterable[Move]) -> list[Move]:
    """By time and tie-break, NULL ties first; equal ones stay as they came."""
    return sorted(moves, key=lambda m: (m.at, m.tie is not None, m.tie or 0))


class Fold:
    """A machine without timers; subclasses add state, row and timer steps."""

    state: str
    output: str
    start: tuple

    def row(self, state: tuple, move: Move) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def due(self, state: tuple) -> int | None:
        """Time of the next timer."""
        return None

    def timer(self, state: tuple, at: int) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError


def advance(
    fold: Fold, state: tuple, moves: Iterable[Move], until: int | None
) -> tuple[tuple, list[tuple]]:
    """Feed sorted moves, then fire the timers up to ``until`` (all of them if None)."""
    out: list[tuple] = []
    for move in moves:
        due = fold.due(state)
        if due is not None and due < move.at:
            state = _fire(fold, state, out, lambda due: due < move.at)
        state, more = fold.row(state, move)
        out += more
    state = _fire(fold, state, out, lambda due: until is None or due <= until)
    return state, out


def _fire(fold, state, out, ready) -> tuple:
    due = fold.due(state)
    while due is not None and ready(due):
        state, more = fold.timer(state, due)
        out += more
        due = fold.due(state)
    return state


class ValueChange(Fold):
    """Rows whose value moved by more than ``threshold``; the last value may expire. NULL forgets it."""

    state = "prev {value}, expires bigint"
    start = (None, None)

    def __init__(
        self, threshold: float = 1.7, initial: float | None = 0.0, expire: int | None = None, events: bool = False
    ):
        self.threshold, self.initial, self.expire, self.events = threshold, initial, expire, events
        self.output = "at bigint, tie bigint, value {value}, diff double" + ", event {event}" * events

    def row(self, state, move):
        value, prev = move.value, state[0]
        if prev is None and value is not None and self.initial is not None:
            prev = type(value)(self.initial)
        diff = None if prev is None or value is None else float(abs(value - prev))
        expires = None if self.expire is None else move.at + self.expire
        if diff is None or not diff > self.threshold:
            return (value, expires), []
        return (value, expires), [(move.at, move.tie, value, diff, *[move.event] * self.events)]

    def due(self, state):
        return state[1]

    def timer(self, state, at):
        return self.start, []


class RiseAlert(Fold):
    """One alert per run without a fall, ``hold`` after its first rise. Next to a NULL nothing rises or falls."""

    state = "prev {value}, alarm bigint, fired boolean"
    output = "alert_at bigint"
    start = (None, None, False)

    def __init__(self, hold: int):
        self.hold = hold

    def row(self, state, move):
        prev, alarm, fired = state
        if prev is not None and move.value is not None:
            if move.value < prev:
                alarm, fired = None, False
            elif move.value > prev and alarm is None:
                alarm = move.at + self.hold
        return (move.value, alarm, fired), []

    def due(self, state):
        return None if state[2] else state[1]

    def timer(self, state, at):
        return (state[0], state[1], True), [(at,)]


class AnchoredCount(Fold):
    """Rows per window that opens at the first row after the last one closed."""

    state = "anchor bigint, n bigint"
    output = "anchor bigint, fired_at bigint, count bigint"
    start = (None, 0)

    def __init__(self, size: int):
        self.size = size

    def row(self, state, move):
        anchor, n = state
        return (move.at if anchor is None else anchor, n + 1), []

    def due(self, state):
        return None if state[0] is None else state[0] + self.size

    def timer(self, state, at):
        return self.start, [(state[0], at, state[1])]


class LoginFailures(Fold):
    """Two failures inside ``within`` of the first, no success before it is over. Events are the first and the last failure."""

    def __init__(
        self, within: int, fail: str = "fail", success: str = "success", rearm: bool = False, events: bool = False
    ):
        self.within, self.fail, self.success, self.rearm, self.events = within, fail, success, rearm, events
        self.state = "alarm bigint, n bigint, fired boolean" + ", first {event}, last {event}" * events
        self.output = "alert_at bigint" + ", first_event {event}, last_event {event}" * events
        self.start = (None, 0, False, *(None, None) * events)

    def row(self, state, move):
        if move.kind == self.success:
            return self.start, []
        if move.kind != self.fail:
            return state, []
        alarm, n, fired, *kept = state
        if self.events:
            kept = [move.event if alarm is None else kept[0], move.event]
        return (move.at + self.within if alarm is None else alarm, n + 1, fired, *kept), []

    def due(self, state):
        return None if state[2] else state[0]

    def timer(self, state, at):
        found = [(at, *state[3:])] if state[1] >= 2 else []
        return (self.start if self.rearm else (state[0], 0, True, *state[3:])), found


class OrderTimeouts(Fold):
    """A creation not followed by a payment when one of the key's timers fires. The event is the creation."""

    def __init__(self, within: int, create: str = "create", pay: str = "pay", events: bool = False):
        self.within, self.create, self.pay, self.events = within, create, pay, events
        self.state = "created bigint, paid boolean, alarms array<bigint>" + ", event {event}" * events
        self.output = "created_at bigint, timeout_at bigint" + ", event {event}" * events
        self.start = (None, False, [], *(None,) * events)

    def row(self, state, move):
        if move.kind not in (self.create, self.pay):
            return state, []
        created, paid, alarms, *kept = state
        if move.kind == self.pay:
            paid = True
        elif created is None:
            created, kept = move.at, [move.event] * self.events
        return (created, paid, [*alarms, move.at + self.within], *kept), []

    def due(self, state):
        return min(state[2], default=None)

    def timer(self, state, at):
        left = [a for a in state[2] if a != at]
        found = [(state[0], at, *state[3:])] if state[0] is not None and not state[1] else []
        return (None, False, left, *self.start[3:]), found


class MinMaxChanges(Fold):
    """The add and retract rows of a key's running (min, max); of NULLs alone both are NULL."""

    state = "x {value}, y {value}, seen boolean"
    output = "at bigint, tie bigint, change int, is_add boolean, x {value}, y {value}"
    start = (None, None, False)

    def row(self, state, move):
        x, y, seen = state
        known = [v for v in (x, y, move.value) if v is not None]
        new = (min(known), max(known)) if known else (None, None)
        if seen and new == (x, y):
            return state, []
        out = [(move.at, move.tie, 0, False, x, y)] if seen else []
        return (*new, True), [*out, (move.at, move.tie, 1, True, *new)]


class SwitchFilter(Fold):
    """Readings inside the interval of any switch; a switch is a move of kind ``switch``."""

    state = "until bigint"
    start = (None,)

    def __init__(self, events: bool = False):
        self.events = events
        self.output = "at bigint, tie bigint, value {value}" + ", event {event}" * events

    def row(self, state, move):
        until = state[0]
        if move.kind == "switch":
            ends = move.at + int(move.value)
            return (ends if until is None else max(until, ends),), []
        passes = until is not None and move.at <= until
        return state, [(move.at, move.tie, move.value, *[move.event] * self.events)] if passes else []

    def due(self, state):
        return state[0]

    def timer(self, state, at):
        return self.start, []


class EventTimers(Fold):
    """One timer per time, ``delay`` after it, however many rows asked for it."""

    state = "alarms array<bigint>"
    output = "at bigint, fire_at bigint"
    start = ([],)

    def __init__(self, delay: int):
        self.delay = delay

    def row(self, state, move):
        alarm = move.at + self.delay
        return (state if alarm in state[0] else ([*state[0], alarm],)), []

    def due(self, state):
        return min(state[0], default=None)

    def timer(self, state, at):
        return ([a for a in state[0] if a != at],), [(at - self.delay, at)]


class Sequence(Fold):
    """Kinds that follow each other directly; a begun match that comes too late is a timeout."""

    state = "begun array<array<bigint>>"
    output = "times array<bigint>, output string"
    start = ([],)

    def __init__(self, kinds: list[str], within: int | None = None, timeouts: bool = False):
        self.kinds, self.within, self.timeouts = kinds, within, timeouts

    def row(self, state, move):
        begun, out = [], []
        for times in state[0]:
            if self.within is not None and move.at - times[0] >= self.within:
                out += self._timeout(times)
            elif move.kind == self.kinds[len(times)]:
                begun.append([*times, move.at])
        if move.kind == self.kinds[0]:
            begun.append([move.at])
        whole = [t for t in begun if len(t) == len(self.kinds)]
        return ([t for t in begun if len(t) < len(self.kinds)],), [*out, *((t, "matched") for t in whole)]

    def due(self, state):
        if self.within is None:
            return None
        return min((t[0] + self.within for t in state[0]), default=None)

    def timer(self, state, at):
        late = [t for t in state[0] if t[0] + self.within <= at]
        out = [found for times in late for found in self._timeout(times)]
        return ([t for t in state[0] if t not in late],), out

    def _timeout(self, times):
        return [(list(times), "timeout")] if self.timeouts else []


class Repetition(Fold):
    """``n`` events of one kind, whatever lies between; one match from every start."""

    state = "times array<bigint>"
    output = "times array<bigint>"
    start = ([],)

    def __init__(self, kind: str, n: int):
        self.kind, self.n = kind, n

    def row(self, state, move):
        if move.kind != self.kind:
            return state, []
        times = [*state[0], move.at]
        if len(times) < self.n:
            return (times,), []
        return (times[1:],), [(times,)]


class EarlyCounts(Fold):
    """Counts of a tumbling window so far at every step boundary after its first row, and at its end."""

    state = "opened bigint, n bigint, boundary bigint"
    output = "window_end bigint, fired_at bigint, count bigint"
    start = (None, 0, None)

    def __init__(self, size: int, step: int):
        if size % step:
            raise ValueError("the step must divide the window size")
        self.size, self.step = size, step

    def row(self, state, move):
        opened, n, boundary = state
        if opened is None:
            opened, boundary = move.at - move.at % self.size, move.at - move.at % self.step + self.step
        return (opened, n + 1, boundary), []

    def due(self, state):
        # Just before the boundary: a row at the boundary itself is not counted by it.
        return None if state[2] is None else state[2] - 1

    def timer(self, state, at):
        opened, n, boundary = state
        out = [(opened + self.size, boundary, n)]
        if boundary == opened + self.size:
            return self.start, out
        return (opened, n, boundary + self.step), out


class PatternMatch(Fold):
    """Steps that follow each other directly, by condition: bit i of a row's value says whether it can be step i.

    A match holds the events of its steps. One whose next row comes ``within`` after its first, or later, or not
    at all, is a timeout with the events it reached. With ``gaps`` a row that can be no step is passed over.
    """

    state = "begun array<struct<began: bigint, events: array<{event}>>>"
    output = "events array<{event}>, output string"
    start = ([],)

    def __init__(self, steps: int, within: int | None = None, timeouts: bool = False, gaps: bool = False):
        self.steps, self.within, self.timeouts, self.gaps = steps, within, timeouts, gaps

    def row(self, state, move):
        if self.gaps and not move.value:
            return state, []
        begun, out = [], []
        candidates = [*((began, list(events)) for began, events in state[0]), (move.at, [])]
        for began, events in candidates:
            if self.within is not None and events and move.at - began >= self.within:
                out += self._timeout(events)
            elif move.value >> len(events) & 1:
                events.append(move.event)
                if len(events) == self.steps:
                    out.append((events, "matched"))
                else:
                    begun.append((began, events))
        return (begun,), out

    def due(self, state):
        if self.within is None:
            return None
        return min((began + self.within for began, _ in state[0]), default=None)

    def timer(self, state, at):
        out = [found for began, events in state[0] if began + self.within <= at for found in self._timeout(events)]
        return ([(b, e) for b, e in state[0] if b + self.within > at],), out

    def _timeout(self, events):
        return [(list(events), "timeout")] if self.timeouts else []
