"""Typed values, NULLs and whole events in streaming state; patterns by condition; the processing clock."""

import datetime
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import rolling, stateful, windows
from tidemark.operators.patterns import Pattern, match
from tidemark.session import shared_dir
from tidemark.streaming import folds, operators, patterns
from tidemark.streaming.processors import run_fold, run_on_arrival

SECOND = 1_000_000
BIG = 2**53 + 1


@pytest.fixture(scope="module")
def events(spark):
    """Large ids as values, NULL values, ties, and a key with many more rows than the others."""
    rng, data = random.Random(11), []
    for seq in range(900):
        key = None if rng.random() < 0.6 else rng.randrange(4)
        value = None if rng.random() < 0.1 else BIG + rng.randrange(-2, 4)
        data.append((key, seq, rng.randrange(600), value, rng.choice(["fail", "success", "create", "pay"])))
    df = spark.createDataFrame(data, "k int, seq long, s long, v long, kind string")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s").cache()


@pytest.fixture(scope="module")
def feed(spark, events, tmp_path_factory):
    """The events out of order in five batches, and a row far in the future as the last one."""
    folder = str(tmp_path_factory.mktemp("typed"))
    for part in range(5):
        events.filter(F.col("seq") % 5 == part).coalesce(1).write.mode("append").parquet(folder)

    end = {"ts": operators.END, "k": 99}
    last = [F.lit(end.get(f.name)).cast(f.dataType).alias(f.name) for f in events.schema]
    spark.range(1).select(*last).coalesce(1).write.mode("append").parquet(folder)

    def stream(where="true"):
        found = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return operators.with_event_time(found, "ts", "20 minutes").filter(where)

    return stream


def done(spark, stream):
    return operators.finished(spark, stream, "test")


def whole():
    return F.struct("seq", "ts", "v", "kind")


def test_values_keep_their_type_and_nulls(spark, events, feed):
    fold = folds.ValueChange(threshold=1, initial=None, events=True)
    got = done(spark, run_fold(feed(), fold, "k", "ts", "seq", value=F.col("v"), event=whole(), slot="10 seconds"))
    batch = stateful.value_change(events, "k", ["ts", "seq"], "v", 1, None)
    assert got.schema["value"].dataType.simpleString() == "bigint" and got.filter("value > 9007199254740992").count() > 100
    assert rows(got.select("k", "tie", "value", "diff", "event")) == rows(
        batch.select("k", "seq", "v", F.col("diff").cast("double"), whole().alias("event"))
    )


def test_changelog_with_nulls(spark, events, feed):
    got = done(spark, run_fold(feed(), folds.MinMaxChanges(), "k", "ts", "seq", value=F.col("v")))
    batch = rolling.retract_changelog(events, ["k"], ["ts", "seq"], "v")
    columns = ["k", "change", "is_add", "x", "y"]
    assert rows(got.select("tie", *columns)) == rows(batch.select("seq", *columns))


def test_changelog_of_a_null_first(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, 2), (1, 4, None), (1, 5, 9)], "k int, seq int, v long")
    got = rolling.retract_changelog(df, ["k"], ["seq"], "v").orderBy("seq", "change").collect()
    assert [(r.seq, r.is_add, r.x, r.y) for r in got] == [
        (1, True, None, None), (3, False, None, None), (3, True, 2, 2), (5, False, 2, 2), (5, True, 2, 9)]


def test_rises_over_nulls(spark, events, feed):
    got = done(spark, run_fold(feed(), folds.RiseAlert(5 * SECOND), "k", "ts", "seq", value=F.col("v")))
    batch = stateful.rise_alerts(events, "k", ["ts", "seq"], "v", "5 seconds")
    assert rows(got) == rows(batch.withColumn("alert_at", F.unix_micros("alert_at")))


def test_login_failures_with_their_events(spark, events, feed):
    fold = folds.LoginFailures(30 * SECOND, events=True)
    got = done(spark, run_fold(feed("k IS NOT NULL"), fold, "k", "ts", "seq", kind=F.col("kind"), event=whole()))
    batch = stateful.login_failures(events.filter("k IS NOT NULL"), "k", ["ts", "seq"], "kind", "30 seconds")
    assert rows(got.select("k", "alert_at")) == rows(batch.withColumn("alert_at", F.unix_micros("alert_at"))) and got.count()
    for r in got.collect():
        first, last = r.first_event, r.last_event
        assert first.kind == last.kind == "fail" and first.seq != last.seq
        assert int(first.ts.replace(tzinfo=datetime.UTC).timestamp()) * SECOND + 30 * SECOND == r.alert_at
        assert first.ts <= last.ts


@pytest.mark.parametrize("timeouts", [False, True])
def test_any_pattern_runs_as_a_stream(spark, events, feed, timeouts):
    v, kind = F.col("v"), F.col("kind")
    found = [
        Pattern.begin("a", kind == "create").next("b", (kind == "pay") | (v > BIG)).within("20 seconds"),
        Pattern.begin("a", v.isNull()).next("b", v.isNotNull()).next("c", v % 2 == 0).within("90 seconds"),
        Pattern.begin("f", kind == "fail").times(3).within("40 seconds"),
    ]
    if not timeouts:
        found.append(Pattern.begin("f", (kind == "fail") & (v > BIG)).times(2))
    for pattern in found:
        got = done(spark, patterns.match(feed("k IS NOT NULL"), pattern, "k", "ts", "seq", timeouts))
        batch = match(events.filter("k IS NOT NULL"), pattern, "k", ["ts", "seq"], timeouts)
        assert got.columns == batch.columns
        assert rows(got) == rows(batch) and got.count()


def test_early_counts_at_boundaries(spark, events, feed):
    got = done(spark, run_fold(feed("k IS NOT NULL"), folds.EarlyCounts(60 * SECOND, 20 * SECOND), "k", "ts", "seq"))
    batch = windows.early_firing(events.filter("k IS NOT NULL"), ["k"], "ts", "1 minute", "20 seconds")
    assert rows(got) == rows(batch.withColumns({c: F.unix_micros(c) for c in ("window_end", "fired_at")}))


def test_many_waiting_rows_are_written_and_read_once(spark, tmp_path):
    """Doubling a key's waiting rows about doubles the time; rows wait through ten batches."""
    took = []
    for n in (10_000, 40_000):
        folder = str(tmp_path / f"in{n}")
        spark.range(n).selectExpr("1 AS k", "id AS seq", "timestamp_millis(1000 + id * 100) AS ts").repartition(10, "seq").write.parquet(folder)
        schema = spark.read.parquet(folder).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        spark.sql(f"SELECT 2 AS k, 0L AS seq, timestamp'{operators.END}' AS ts").coalesce(1).write.mode("append").parquet(folder)
        stream = operators.with_event_time(stream, "ts", "5 hours")
        began = time.time()
        got = done(spark, run_fold(stream, folds.AnchoredCount(SECOND), "k", "ts", "seq"))
        took.append(time.time() - began)
        assert got.filter("k = 1").agg(F.sum("count")).first()[0] == n
    assert took[1] < 8 * took[0]


def test_the_processing_clock_fires_timers(spark, tmp_path):
    """A window opens with a key's first row and is counted after a second of the clock, though no rows come."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(40).selectExpr("id % 4 AS k", "id AS seq").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("k long, seq long").parquet(folder)
    counts = run_on_arrival(stream, folds.AnchoredCount(SECOND), "k", "seq")
    query = counts.writeStream.option("checkpointLocation", shared_dir(spark, "clock")).format("parquet").start(out)
    try:
        for _ in range(120):
            time.sleep(0.5)
            if spark.read.schema(counts.schema).parquet(out).count() == 4:
                break
    finally:
        query.stop()
    got = spark.read.parquet(out).collect()
    assert sorted((r.k, r["count"]) for r in got) == [(k, 10) for k in range(4)]
    assert all(r.fired_at - r.anchor == SECOND for r in got)
