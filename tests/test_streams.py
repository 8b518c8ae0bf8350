"""Streaming forms over several small batches that arrive out of order, against the batch forms.

Rows the final watermark has not passed are still in state, so batch results are cut there.
"""

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import joins, rank, rolling, stateful, visitors, windows
from tidemark.operators.patterns import Pattern, match
from tidemark.plans.durations import micros
from tidemark.plans.panes import count_rows, sliding
from tidemark.session import shared_dir
from tidemark.streaming import folds, operators
from tidemark.streaming.processors import run_fold

HOUR = 3_600_000_000
DELAY = "11 hours"
FILES = 4


@pytest.fixture(scope="module")
def events(spark, sf):
    """The events, up to ten hours out of order on arrival."""
    df = model.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    wait = ((F.col("event_id") * 37) % 20) * F.expr("INTERVAL 30 MINUTE")
    return df.withColumn("arrival", F.col("ts") + wait).cache()


@pytest.fixture(scope="module")
def feed(spark, events, tmp_path_factory):
    """A stream of the events that gets one file per batch, in order of arrival."""
    folder = str(tmp_path_factory.mktemp("feed"))
    parts = events.withColumn("part", F.ntile(FILES).over(Window.orderBy("arrival")))
    for part in range(1, FILES + 1):
        parts.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return lambda where="true", delay=DELAY: stream.withWatermark("ts", delay).filter(where)


@pytest.fixture(scope="module")
def passed(events):
    """The final watermark, in microseconds."""
    last = events.agg(F.max(F.unix_micros("ts")).alias("t")).first().t
    return (last - micros(DELAY)) // 1000 * 1000


def done(spark, stream):
    return operators.finished(spark, stream, "test")


def test_tumble_count(spark, events, feed, passed):
    n = F.count(F.lit(1)).alias("count")
    batch = windows.tumbling(events, ["user_id"], "ts", "1 day", n).filter(F.unix_micros("window_end") <= passed)
    assert rows(done(spark, operators.tumble_count(feed(), ["user_id"], "ts", "1 day"))) == rows(batch)


def test_unique_visitors(spark, events, feed, passed):
    got = rows(done(spark, operators.unique_visitors(feed(), "user_id", "ts", "1 hour")))
    every = events.withColumn("behavior", F.lit("pv"))
    batch = visitors.exact(every).filter(F.unix_micros("window_end") <= passed)
    assert got == rows(batch)


def test_top_items(spark, events, feed, passed):
    path = shared_dir(spark, "ranked")
    operators.rank_batches(
        feed().withColumn("item", F.col("event_id") % 7), "item", "ts", "2 hours", "30 minutes", 3,
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"),
        shared_dir(spark, "ranked-checkpoint"),
    ).awaitTermination()
    got = spark.read.parquet(path).select("window_end", "item", "count", "row_num")
    whole = rank.top_per_window(events.withColumn("item", F.col("event_id") % 7), "item", "ts", "2 hours", "30 minutes", 3)
    assert rows(got) == rows(whole.filter(F.unix_micros("window_end") <= passed))


@pytest.mark.parametrize("together", ["30 minutes", "90 minutes", "5 hours"])
def test_counts_of_windows_that_are_out_together(spark, events, together, monkeypatch):
    monkeypatch.setattr(operators, "CELLS", 40)  # a few rows of a stretch at a time
    path = shared_dir(spark, "out-together-source")
    named = events.select(F.when(F.col("event_id") % 7 > 0, F.col("event_id") % 7).alias("item"), "ts")
    named.write.parquet(path)
    source = operators.with_end(spark.readStream.schema(named.schema).parquet(path), "ts")
    source = operators.with_event_time(source, "ts", DELAY)
    counts = done(spark, operators.sliding_counts(source, ["item"], "ts", "2 hours", "30 minutes", together))
    whole = sliding(named, ["item"], "ts", "2 hours", "30 minutes", count=count_rows())
    assert rows(counts) == rows(whole)
    ranked = shared_dir(spark, "out-together")
    operators.rank_batches(
        source, "item", "ts", "2 hours", "30 minutes", 2,
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{ranked}/batch={number}"),
        shared_dir(spark, "out-together-checkpoint"), together,
    ).awaitTermination()
    got = spark.read.parquet(ranked).select("window_end", "item", "count", "row_num")
    assert rows(got) == rows(rank.top_per_window(named, "item", "ts", "2 hours", "30 minutes", 2))


def folded(spark, feed, fold, **columns):
    return done(spark, run_fold(feed(), fold, "user_id", "ts", "event_id", **columns))


def test_value_change(spark, events, feed, passed):
    got = folded(spark, feed, folds.ValueChange(expire=6 * HOUR), value=F.col("value"))
    batch = stateful.value_change(events, "user_id", ["ts", "event_id"], "value", expire="6 hours")
    batch = batch.filter(F.unix_micros("ts") <= passed)
    assert rows(got.select("tie", "diff")) == rows(batch.select("event_id", "diff"))


def test_rise(spark, events, feed, passed):
    got = folded(spark, feed, folds.RiseAlert(12 * HOUR), value=F.col("value"))
    batch = stateful.rise_alerts(events, "user_id", ["ts", "event_id"], "value", "12 hours")
    batch = batch.withColumn("alert_at", F.unix_micros("alert_at")).filter(F.col("alert_at") <= passed)
    assert rows(got) == rows(batch)


def test_anchored(spark, events, feed, passed):
    got = folded(spark, feed, folds.AnchoredCount(12 * HOUR))
    batch = stateful.anchored_windows(events, ["user_id"], "ts", "12 hours")
    batch = batch.withColumns({c: F.unix_micros(c) for c in ("anchor", "fired_at")}).filter(F.col("fired_at") <= passed)
    assert rows(got) == rows(batch)


def test_login(spark, events, feed, passed):
    for rearm in (False, True):
        fold = folds.LoginFailures(12 * HOUR, "error", "signup", rearm)
        got = folded(spark, feed, fold, kind=F.col("event_type"))
        batch = stateful.login_failures(
            events, "user_id", ["ts", "event_id"], "event_type", "12 hours", "error", "signup", rearm
        )
        batch = batch.withColumn("alert_at", F.unix_micros("alert_at")).filter(F.col("alert_at") <= passed)
        assert rows(got) == rows(batch)


def test_order_timeouts(spark, events, feed, passed):
    got = folded(spark, feed, folds.OrderTimeouts(12 * HOUR, "click", "purchase"), kind=F.col("event_type"))
    batch = stateful.order_timeouts(events, "user_id", "ts", "event_type", "event_id", "12 hours", "click", "purchase")
    batch = batch.withColumns({c: F.unix_micros(c) for c in ("created_at", "timeout_at")})
    assert rows(got) == rows(batch.filter(F.col("timeout_at") <= passed))


def test_changelog(spark, events, feed, passed):
    got = folded(spark, feed, folds.MinMaxChanges(), value=F.floor("value"))
    batch = rolling.retract_changelog(events, ["user_id"], ["ts", "event_id"], "value")
    batch = batch.filter(F.unix_micros("ts") <= passed)
    assert rows(got.select("tie", "change", "is_add", "x", "y")) == rows(batch.select("event_id", "change", "is_add", "x", "y"))


def test_event_timers(spark, events, feed, passed):
    got = folded(spark, feed, folds.EventTimers(9_999_000))
    batch = stateful.event_timers(events, "user_id", "ts").withColumn("fire_at", F.unix_micros("fire_at"))
    batch = batch.filter(F.col("fire_at") <= passed)
    assert rows(got.select("user_id", "fire_at")) == rows(batch.select("user_id", "fire_at"))


def test_patterns(spark, events, feed, passed):
    kind = F.col("event_type")
    got = folded(spark, feed, folds.Sequence(["click", "purchase"], 12 * HOUR, timeouts=True), kind=kind)
    pattern = Pattern.begin("create", kind == "click").next("pay", kind == "purchase").within("12 hours")
    batch = match(events, pattern, "user_id", ["ts", "event_id"], timeouts=True)
    created, paid = F.unix_micros("create.ts"), F.unix_micros("pay.ts")
    # A verdict is out once the watermark has passed the payment, or the end of the wait.
    known = F.when(F.col("output") == "matched", paid).otherwise(created + 12 * HOUR) <= passed
    sure = F.col("times")[0] <= passed - 12 * HOUR
    want = batch.filter(known).select("user_id", F.array_compact(F.array(created, paid)).alias("times"), "output")
    assert rows(got.filter(sure)) == rows(want.filter(sure))

    got = folded(spark, feed, folds.Repetition("error", 3), kind=kind)
    batch = match(events, Pattern.begin("f", kind == "error").times(3), "user_id", ["ts", "event_id"])
    times = F.array(*[F.unix_micros(f"f_{i}.ts") for i in (1, 2, 3)]).alias("times")
    assert rows(got) == rows(batch.select("user_id", times).filter(F.col("times")[2] <= passed))


def test_updating_counts(spark, sf, events, tmp_path):
    raw = spark.readStream.schema(events.schema).parquet(_folder(events, str(tmp_path / "in")))
    path = str(tmp_path / "out")
    operators.updating_counts(
        raw, ["user_id"], "ts", "1 day", "6 hours", "2 hours",
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"), str(tmp_path / "c"),
    ).awaitTermination()
    n = F.count(F.lit(1)).alias("count")
    last = spark.read.parquet(path).groupBy("user_id", "window_end").agg(F.max("count").alias("count"))
    whole = windows.tumbling(events, ["user_id"], "ts", "1 day", n).select("user_id", "window_end", "count")
    assert rows(last) == rows(whole)


def _folder(events, path):
    events.coalesce(1).write.parquet(path)
    return path


@pytest.mark.parametrize("size", [None, "1 hour"])
def test_route_late(spark, events, feed, tmp_path, size):
    sinks = {k: str(tmp_path / k) for k in ("main", "late")}
    writers = {k: (lambda df, p=p: df.write.mode("append").parquet(p)) for k, p in sinks.items()}
    stream = feed()
    operators.route_late(stream, "ts", "3 hours", writers, str(tmp_path / "tops"), str(tmp_path / "c"), size).awaitTermination()
    part = F.ntile(FILES).over(Window.orderBy("arrival"))
    parts = events.withColumn("at", F.unix_micros("ts")).withColumn("part", part)
    tops = {r.part: r.top for r in parts.groupBy("part").agg(F.max("at").alias("top")).collect()}
    marks = F.create_map(*[F.lit(v) for p in range(2, FILES + 1) for v in (p, max(tops[q] for q in range(1, p)) - 3 * HOUR)])
    edge = F.col("at") if size is None else F.floor(F.col("at") / HOUR) * HOUR + HOUR - 1
    late = parts.filter(edge < marks[F.col("part")])
    assert late.count() > 0
    assert rows(spark.read.parquet(sinks["late"]).select("event_id")) == rows(late.select("event_id"))
    assert spark.read.parquet(sinks["main"]).count() == events.count() - late.count()


def test_interval_join(spark, events, feed):
    clicks = feed("event_type = 'click'").select("user_id", F.col("ts").alias("a"), F.col("event_id").alias("x"))
    buys = feed("event_type = 'purchase'").select("user_id", F.col("ts").alias("b"), F.col("event_id").alias("y"))
    got = done(spark, operators.interval_join(clicks, buys, "user_id", "a", "b", "-2 hours", "3 hours"))
    left = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("a"), F.col("event_id").alias("x"))
    right = events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("b"), F.col("event_id").alias("y"))
    batch = joins.interval_join(left, right, ["user_id"], "a", "b", "-2 hours", "3 hours")
    assert rows(got.select("x", "y")) == rows(batch.select("x", "y"))


def test_reconcile(spark, events, feed, passed):
    def sides(of):
        return (
            of("event_type = 'click'").select("user_id", F.col("ts").alias("o")),
            of("event_type = 'purchase'").select("user_id", F.col("ts").alias("p")),
        )

    got = done(spark, operators.reconcile(*sides(feed), "user_id", "o", "p", "2 hours"))
    batch = joins.reconcile(*sides(lambda where: events.filter(where)), "user_id", "o", "p", "2 hours")
    # Each input's watermark is at or after ``passed``; unmatched rows leave the state two hours on.
    sure = passed - 3 * HOUR
    at = F.coalesce("order_at", "pay_at")
    keep = F.unix_micros(at) < sure
    assert rows(got.filter(keep)) == rows(batch.filter(keep))
    assert got.exceptAll(batch).count() == 0


def test_two_watermarks_take_the_smaller(spark, events, feed):
    """A union of inputs with different delays closes windows by the slower one."""
    both = feed("event_id % 2 = 0").unionByName(feed("event_id % 2 = 1", "60 hours"))
    got = done(spark, operators.tumble_count(both, [], "ts", "1 day"))
    last = events.agg(F.max(F.unix_micros("ts")).alias("t")).first().t
    n = F.count(F.lit(1)).alias("count")
    batch = windows.tumbling(events, [], "ts", "1 day", n)
    assert rows(got) == rows(batch.filter(F.unix_micros("window_end") <= last - micros("60 hours")))


def test_early_counts(spark, feed, tmp_path):
    seen = []
    query = operators.early_counts(
        feed(), ["user_id"], "ts", "1 day", "1 second", lambda batch, _: seen.append(batch.count()), str(tmp_path / "c")
    )
    query.processAllAvailable()
    query.stop()
    assert sum(seen) >= 397
