"""Batch operators, whole and cut in pieces, against the state machines run over sorted lists."""

import random

import pytest
from conftest import POLICIES, rows
from pyspark.sql import functions as F

from tidemark.operators import rolling, stateful
from tidemark.operators.patterns import Pattern, match
from tidemark.plans.ordered import (
    HotKeys,
    Ordered,
    first_row,
    latest,
    next_row,
    previous_row,
    running_count,
    running_max,
    running_min,
    running_sum,
    upcoming,
)
from tidemark.streaming import folds
from tidemark.streaming.folds import Move, advance

SECOND = 1_000_000


def random_events(seed=7, keys=150):
    """Keys with bursts, ties and long pauses, and one key that is far larger than the others."""
    rng = random.Random(seed)
    data, seq = [], 0
    for key in range(keys):
        now = rng.randint(0, 20)
        for _ in range(400 if key == 0 else rng.randint(1, 14)):
            now += rng.choice([0, 0, 1, 1, 2, 3, 4, 5, 6, 11, 30])
            data.append((key, seq, now * SECOND, float(rng.randint(0, 6)), rng.choice(["fail", "success", "create", "pay"])))
            seq += 1
    rng.shuffle(data)
    return data


DATA = random_events()


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame(DATA, "key long, seq long, at long, v double, k string")
    df = df.withColumn("ts", F.timestamp_micros("at")).drop("at")
    df.cache().count()
    return df


def by_key(fold, kinds=None):
    """The machine's output over each key's rows in order, with the key in front."""
    keys = {}
    for key, seq, at, v, k in DATA:
        if kinds is None or k in kinds:
            keys.setdefault(key, []).append(Move(at, seq, v, k))
    out = []
    for key, moves in keys.items():
        out += [(key, *found) for found in advance(fold, fold.start, sorted(moves), None)[1]]
    return sorted(out, key=repr)


def micros(df, *columns):
    return df.withColumns({c: F.unix_micros(c) for c in columns})


@pytest.mark.parametrize("initial,expire", [(0.0, None), (None, None), (0.0, 5 * SECOND)])
def test_value_change(events, hot, initial, expire):
    out = stateful.value_change(events, "key", ["ts", "seq"], "v", 1.7, initial, expire, hot)
    assert rows(micros(out, "ts").select("key", "ts", "seq", "v", "diff")) == by_key(folds.ValueChange(1.7, initial, expire))


@pytest.mark.parametrize("hold", [1, 5])
def test_rise(events, hot, hold):
    out = stateful.rise_alerts(events, "key", ["ts", "seq"], "v", hold * SECOND, hot)
    assert rows(micros(out, "alert_at")) == by_key(folds.RiseAlert(hold * SECOND))


@pytest.mark.parametrize("size", [1, 4, 10])
def test_anchored(events, size):
    want = by_key(folds.AnchoredCount(size * SECOND))
    for policy in (HotKeys(), HotKeys(1, 3), HotKeys(100, 1)):
        out = stateful.anchored_windows(events, ["key"], "ts", size * SECOND, policy)
        assert rows(micros(out, "anchor", "fired_at")) == want


@pytest.mark.parametrize("rearm", [False, True])
def test_login(events, hot, rearm):
    out = stateful.login_failures(events, "key", ["ts", "seq"], "k", "5 seconds", rearm=rearm, hot=hot)
    assert rows(micros(out, "alert_at")) == by_key(folds.LoginFailures(5 * SECOND, rearm=rearm))


def test_order_timeouts(events, hot):
    out = stateful.order_timeouts(events, "key", "ts", "k", "seq", hot=hot)
    assert rows(micros(out, "created_at", "timeout_at")) == by_key(folds.OrderTimeouts(5 * SECOND))


def test_changelog(events, hot):
    out = rolling.retract_changelog(events, ["key"], ["ts", "seq"], "v", hot=hot)
    assert rows(micros(out, "ts")) == by_key(folds.MinMaxChanges())


def test_patterns(events, hot):
    def ordered(key, kinds):
        return sorted((at, seq, k) for x, seq, at, _, k in DATA if x == key and k in kinds)

    keys = {d[0] for d in DATA}
    want = []
    for key in keys:
        seen = ordered(key, {"create", "pay"})
        for i, (at, seq, k) in enumerate(seen):
            if k != "create":
                continue
            after = seen[i + 1] if i + 1 < len(seen) else None
            if after is None or after[0] - at >= 5 * SECOND:
                want.append((key, seq, None, "timeout"))
            elif after[2] == "pay":
                want.append((key, seq, after[1], "matched"))
    kind = F.col("k")
    pattern = Pattern.begin("create", kind == "create").next("pay", kind == "pay").within("5 seconds")
    out = match(events.filter(kind.isin("create", "pay")), pattern, "key", ["ts", "seq"], timeouts=True, hot=hot)
    assert rows(out.select("key", "create.seq", "pay.seq", "output")) == sorted(want, key=repr)

    thrice = []
    for key in keys:
        fails = ordered(key, {"fail"})
        thrice += [(key, *(f[1] for f in fails[i:i + 3])) for i in range(len(fails) - 2)]
    out = match(events, Pattern.begin("f", kind == "fail").times(3), "key", ["ts", "seq"], hot=hot)
    assert rows(out.select("key", "f_1.seq", "f_2.seq", "f_3.seq")) == sorted(thrice, key=repr)


@pytest.mark.parametrize("keys", [["key"], []], ids=["keyed", "global"])
def test_ordered(events, hot, keys):
    fail = F.when(F.col("k") == "fail", F.col("seq"))
    out = Ordered(events, keys, ["ts", "seq"], hot).running(
        total=running_sum(F.col("seq")),
        before=running_count(inclusive=False),
        low=running_min(F.col("v")),
        high=running_max(F.col("v"), inclusive=False),
        first=first_row(F.col("k")),
        last_fail=latest(fail),
        next_fail=upcoming(fail, inclusive=False),
        prev=previous_row(F.col("k")),
        next=next_row(F.col("seq")),
    )
    got = {r.seq: r for r in out.rows().collect()}
    assert len(got) == len(DATA)
    groups = {}
    for d in sorted(DATA, key=lambda d: (d[2], d[1])):
        groups.setdefault(d[0] if keys else 0, []).append(d)
    for group in groups.values():
        for i, (_, seq, _, _, _) in enumerate(group):
            r, so_far, later = got[seq], group[: i + 1], group[i + 1:]
            assert r.total == sum(d[1] for d in so_far)
            assert (r.before or 0) == i
            assert r.low == min(d[3] for d in so_far)
            assert r.high == max((d[3] for d in group[:i]), default=None)
            assert r.first == group[0][4]
            assert r.last_fail == next((d[1] for d in reversed(so_far) if d[4] == "fail"), None)
            assert r.next_fail == next((d[1] for d in later if d[4] == "fail"), None)
            assert r.prev == (group[i - 1][4] if i else None)
            assert r.next == (later[0][1] if later else None)


def test_policies_cut_differently(events):
    counts = {}
    for name, policy in POLICIES.items():
        ordered = Ordered(events, ["key"], ["ts", "seq"], policy)
        counts[name] = ordered.df.select("key", "_piece").distinct().count() if ordered.cut else 0
    assert counts["whole"] < counts["some"] < counts["all"]
