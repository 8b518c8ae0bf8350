"""Panes against ``F.window``, and bucketed joins against plain ones, on random data."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import joins, rolling
from tidemark.plans.panes import count_rows, max_of, min_of, sliding, sliding_plain, sum_of


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 4), rng.randint(-5_000, 40_000), rng.randint(0, 9)) for _ in range(1500)]
    df = spark.createDataFrame(data, "k int, s int, v int")
    return df.withColumn("ts", F.timestamp_seconds("s")).cache()


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("10 seconds", "5 seconds"), ("60 seconds", "60 seconds"), ("7 minutes", "2 minutes")])
@pytest.mark.parametrize("keys", [["k"], []], ids=["keyed", "all"])
@pytest.mark.parametrize("zone", ["timestamp", "timestamp_ntz"])
def test_panes(points, size, slide, keys, zone):
    taken_back = {"n": count_rows(), "total": sum_of("v")}
    merged = {**taken_back, "low": min_of("v"), "high": max_of("v"), "real": sum_of(F.col("v") * 0.5)}
    df = points.withColumn("ts", F.col("ts").cast(zone)).withColumn("v", F.when(F.col("v") != 4, F.col("v")))
    for aggs in (taken_back, merged):
        mine, plain = (f(df, keys, "ts", size, slide, **aggs) for f in (sliding, sliding_plain))
        assert mine.schema["window_end"].dataType == plain.schema["window_end"].dataType
        assert rows(mine) == rows(plain)


@pytest.mark.parametrize("lower,upper", [("-60 seconds", "60 seconds"), ("0 seconds", "30 seconds"), ("-90 seconds", "-10 seconds")])
def test_interval_join(points, lower, upper):
    left = points.limit(700).select("k", F.col("ts").alias("a"), F.col("v").alias("x"))
    right = points.select("k", F.col("ts").alias("b"), F.col("v").alias("y"))
    mine = joins.interval_join(left, right, ["k"], "a", "b", lower, upper)
    near = F.col("b").between(F.col("a") + F.expr(f"INTERVAL '{lower}'"), F.col("a") + F.expr(f"INTERVAL '{upper}'"))
    plain = left.join(right, "k").filter(near)
    assert mine.count() > 0 and rows(mine) == rows(plain.select(*mine.columns))


def test_reconcile(points):
    orders = points.filter("v < 3").select("k", F.col("ts").alias("o"))
    orders = orders.unionByName(orders.limit(20))
    pays = points.filter("v > 6").select("k", F.col("ts").alias("p"))
    pays = pays.unionByName(pays.limit(30))
    near = F.abs(F.unix_micros("o") - F.unix_micros("p")) <= 45_000_000
    full = orders.join(pays.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & near, "full_outer")
    kind = F.when(F.col("p").isNull(), "unmatched_order").when(F.col("o").isNull(), "unmatched_pay").otherwise("matched")
    plain = full.select(F.coalesce("k", "k2").alias("k"), "o", "p", kind.alias("output"))
    mine = joins.reconcile(orders, pays, "k", "o", "p", "45 seconds")
    assert {r.output for r in mine.collect()} == {"matched", "unmatched_order", "unmatched_pay"}
    assert rows(mine) == rows(plain)


def test_switches(spark, points, hot):
    readings = points.withColumn("seq", F.monotonically_increasing_id()).select("k", "ts", "seq")
    on = points.filter("v = 1").select("k", "ts", ((F.col("s") % 300) * 1_000_000).cast("long").alias("d"))
    mine = joins.switch_filter(readings, on, "k", "ts", "d", "seq", hot=hot)
    ends = F.unix_micros("ts") - F.unix_micros("t")
    plain = readings.join(on.select("k", F.col("ts").alias("t"), "d"), "k").filter(ends.between(0, F.col("d")))
    assert rows(mine.select("seq")) == rows(plain.select("seq").distinct())


def test_list_places_are_linear_and_any_list_is_a_range(spark, hot):
    data = [(None if i < 150 else i % 2, i, [] if i % 5 == 0 else None if i % 7 == 0 else [f"{i}.{j}" for j in range(i % 4)]) for i in range(200)]
    df = spark.createDataFrame(data, "k int, seq int, words array<string>")
    places = {(r.k, r.place): r.element for r in rolling.rolling_elements(df, ["k"], ["seq"], "words", hot).collect()}
    sizes = {(r.k, r.seq): r.size for r in rolling.rolling_elements(df, ["k"], ["seq"], "words", hot).collect()}
    assert len(places) == sum(len(w or []) for _, _, w in data)
    lists = {}
    for k, seq, words in data:
        lists[k] = lists.get(k, []) + (words or [])
        if words:
            assert [places[k, i] for i in range(sizes[k, seq])] == lists[k]


def test_reconcile_repeated_records_and_null_keys(spark):
    orders = [(1, 10), (1, 10), (1, 40), (None, 10), (2, 5), (3, 7)]
    pays = [(1, 12), (1, 12), (1, 100), (None, 10), (2, 8), (4, 1)]
    left = spark.createDataFrame(orders, "k int, a long")
    right = spark.createDataFrame(pays, "k int, b long")
    want = [(k, a, b, "matched") for k, a in orders for j, b in pays if k is not None and k == j and abs(a - b) <= 3]
    want += [(k, a, None, "unmatched_order") for k, a in orders if not any(k == j and k is not None and abs(a - b) <= 3 for j, b in pays)]
    want += [(j, None, b, "unmatched_pay") for j, b in pays if not any(k == j and k is not None and abs(a - b) <= 3 for k, a in orders)]
    got = joins.reconcile(left, right, "k", "a", "b", 3).select("k", "order_at", "pay_at", "output")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
