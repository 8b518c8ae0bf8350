"""Small inputs with rows worked out by hand."""

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import user
from tidemark.operators import basic, joins, late, rolling, stateful, windows
from tidemark.operators.patterns import Pattern, match
from tidemark.plans.panes import early_firing

SECOND = 1_000_000


def at(df, *columns):
    """Seconds columns as timestamps."""
    return df.withColumns({c: F.timestamp_micros((F.col(c).cast("decimal(12,6)") * SECOND).cast("bigint")) for c in columns})


def seconds(df, *columns):
    return df.withColumns({c: F.unix_micros(c) / SECOND for c in columns})


def events(spark, data, schema):
    return at(spark.createDataFrame(data, schema), "ts").withColumn("seq", F.monotonically_increasing_id())


def test_rolling_sum_keeps_first_record(spark, hot):
    df = spark.createDataFrame([(1, 1, 2, 2), (2, 2, 3, 1), (3, 2, 2, 4), (4, 1, 5, 3)], "seq long, k int, a int, b int")
    out = rolling.rolling_sum(df, ["k"], ["seq"], "a", ["b"], hot=hot).orderBy("seq").select("k", "a", "b")
    assert [tuple(r) for r in out.collect()] == [(1, 2, 2), (2, 3, 1), (2, 5, 1), (1, 7, 2)]


def test_rolling_word_count(spark, hot):
    df = spark.createDataFrame([(1, "hello world"), (2, "hello spark")], "line long, text string")
    words = basic.tokenize(df, "text", " ")
    out = rolling.rolling_count(words, ["word"], ["line", "pos"], hot=hot).orderBy("line", "pos")
    assert [(r["word"], r["count"]) for r in out.collect()] == [("hello", 1), ("world", 1), ("hello", 2), ("spark", 1)]


def test_rolling_concat(spark):
    df = spark.createDataFrame([(1, "en", ["tea"]), (2, "fr", ["vin"]), (3, "en", ["cake"])], "seq long, k string, w array<string>")
    out = rolling.rolling_concat(df, ["k"], ["seq"], "w").orderBy("seq")
    assert [(r.k, r.w) for r in out.collect()] == [("en", ["tea"]), ("fr", ["vin"]), ("en", ["tea", "cake"])]


def test_plus_and_repeat(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    assert rows(basic.plus(df, "v")) == [(2,), (3,), (4,)]
    times = F.when(F.col("v") == 2, 1).when(F.col("v") == 3, 2).otherwise(0)
    assert rows(basic.repeat_rows(df, times).select("v")) == [(2,), (3,), (3,)]


def test_split_and_select(spark):
    df = spark.createDataFrame([(1001, "1001"), (999, "999")], "n int, s string")
    parts = basic.label_parts(df, F.when(F.col("n") > 1000, "large").otherwise("small"))
    assert rows(basic.select_parts(parts, "large").select("n")) == [(1001,)]
    assert rows(basic.select_parts(parts, "small").select("n")) == [(999,)]
    assert basic.select_parts(parts, "small", "large").count() == 2


def test_side_output(spark):
    df = spark.createDataFrame([("a", 31.9), ("b", 32.0)], "id string, t double")
    out = basic.side_output(df, F.col("t") < 32.0, "alarm", F.concat(F.lit("cold "), F.col("id")))
    assert rows(out) == [("a", 31.9, "alarm", "cold a"), ("a", 31.9, "main", None), ("b", 32.0, "main", None)]


def test_connect(spark):
    one = spark.createDataFrame([(k, k) for k in (1, 2, 3)], "k int, n long")
    two = spark.createDataFrame([(k, str(k)) for k in (1, 2, 3)], "k int, s string")
    both = basic.connect(one, two)
    out = basic.co_map(both, ["k"], F.lit("first"), F.lit("second"))
    assert rows(out) == [(k, s) for k in (1, 2, 3) for s in ("first", "second")]
    flat = basic.co_flat_map(both.filter("k < 3"), ["k"], F.lit("first"), F.lit("second"), 1, 2)
    assert sorted(r["value"] for r in flat.collect()) == ["first"] * 2 + ["second"] * 4


def test_interval_join_bounds(spark):
    orders = at(spark.createDataFrame([("1", 4), ("2", 5), ("3", 9), ("5", 10)], "id string, o int"), "o")
    pays = at(spark.createDataFrame([("1", 7), ("2", 8), ("4", 10), ("5", 20)], "id string, p int"), "p")
    assert rows(joins.interval_join(orders, pays, ["id"], "o", "p").select("id")) == [("1",), ("2",)]
    edge = at(spark.createDataFrame([("x", 5), ("x", 15), ("x", 16), ("x", 4)], "id string, p int"), "p")
    one = at(spark.createDataFrame([("x", 10)], "id string, o int"), "o")
    assert rows(seconds(joins.interval_join(one, edge, ["id"], "o", "p"), "p").select("p")) == [(15.0,), (5.0,)]


def test_window_join(spark):
    a = at(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, a double"), "a")
    b = at(spark.createDataFrame([(1, 1.2), (1, 1.5), (2, 2.0), (1, 5.0)], "k int, b double"), "b")
    assert joins.window_join(a, b, ["k"], "a", "b", "5 seconds").count() == 3


def test_reconcile(spark):
    orders = at(spark.createDataFrame([("1", 4), ("2", 5), ("3", 9)], "id string, o int"), "o")
    pays = at(spark.createDataFrame([("1", 7), ("2", 8), ("4", 10)], "id string, p int"), "p")
    out = joins.reconcile(orders, pays, "id", "o", "p").select("id", "output")
    assert rows(out) == [("1", "matched"), ("2", "matched"), ("3", "unmatched_order"), ("4", "unmatched_pay")]


def test_reconcile_repeated_keys(spark):
    orders = at(spark.createDataFrame([("a", 0), ("a", 3), ("a", 20)], "id string, o int"), "o")
    pays = at(spark.createDataFrame([("a", 5), ("a", 14), ("a", 40)], "id string, p int"), "p")
    out = seconds(joins.reconcile(orders, pays, "id", "o", "p"), "order_at", "pay_at")
    assert rows(out.select("order_at", "pay_at", "output")) == [
        (0.0, 5.0, "matched"),
        (20.0, None, "unmatched_order"),
        (3.0, 5.0, "matched"),
        (None, 14.0, "unmatched_pay"),
        (None, 40.0, "unmatched_pay"),
    ]


def test_switch_filter(spark, hot):
    readings = events(spark, [("a", 0.0), ("a", 10.0), ("a", 10.001), ("b", 1.0)], "id string, ts double")
    on = at(spark.createDataFrame([("a", 0.0, 10 * SECOND)], "id string, ts double, d long"), "ts")
    out = joins.switch_filter(readings, on, "id", "ts", "d", "seq", hot=hot)
    assert rows(seconds(out, "ts").select("id", "ts")) == [("a", 0.0), ("a", 10.0)]


def test_switch_filter_first_timer_wins(spark, hot):
    readings = events(spark, [("a", 9.0), ("a", 12.0), ("a", 21.0)], "id string, ts double")
    on = at(spark.createDataFrame([("a", 0.0, 10 * SECOND), ("a", 5.0, 10 * SECOND)], "id string, ts double, d long"), "ts")
    union = joins.switch_filter(readings, on, "id", "ts", "d", "seq", hot=hot)
    assert rows(seconds(union, "ts").select("ts")) == [(12.0,), (9.0,)]
    wins = joins.switch_filter(readings, on, "id", "ts", "d", "seq", first_timer_wins=True, hot=hot)
    assert rows(seconds(wins, "ts").select("ts")) == [(9.0,)]


def test_changelog(spark, hot):
    df = spark.createDataFrame([(1, 1, -1), (2, 1, 2), (3, 1, 0)], "seq long, k int, v int")
    out = rolling.retract_changelog(df, ["k"], ["seq"], "v", hot=hot).orderBy("seq", "change")
    assert [(r.is_add, r.k, r.x, r.y) for r in out.collect()] == [(True, 1, -1, -1), (False, 1, -1, -1), (True, 1, -1, 2)]
    assert rows(df.filter("seq < 3").groupBy("k").agg(*user.min_max(F.col("v")))) == [(1, -1, 2)]


def test_lateral_words(spark):
    df = spark.createDataFrame([("hello#world",), ("left#right",), ("#",)], "s string")
    cross = user.split_words(df, "s", "#", keep_empty=False).select("word", "length")
    assert rows(cross) == [("hello", 5), ("left", 4), ("right", 5), ("world", 5)]
    left = user.split_words(df, "s", "#", keep_empty=True)
    assert ("#", None, None) in rows(left) and left.count() == 5
    user.register_split_words(spark)
    df.createOrReplaceTempView("texts")
    sql = "SELECT s, word, length FROM texts LEFT JOIN LATERAL split_words(s) ON TRUE"
    assert rows(spark.sql(sql)) == rows(left)
    assert rows(spark.sql("SELECT word, length FROM texts, LATERAL split_words(s)")) == rows(cross)


def test_top_two(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("a", 3.0), ("b", 1.0)], "id string, v double")
    assert rows(user.top_two(df, "id", "v")) == [("a", 5.0, 1), ("a", 5.0, 2), ("b", 1.0, 1)]
    assert rows(user.top_two(df, "id", "v", pad=True)) == [("a", 5.0, 1), ("a", 5.0, 2), ("b", -2147483648.0, 2), ("b", 1.0, 1)]


def test_value_change(spark, hot):
    df = events(spark, [("a", 1, 20.0), ("a", 2, 21.0), ("a", 3, 23.0)], "id string, ts int, v double")
    t1 = stateful.value_change(df, "id", ["ts", "seq"], "v", hot=hot).select("v", "diff")
    assert rows(t1) == [(20.0, 20.0), (23.0, 2.0)]
    t2 = stateful.value_change(df, "id", ["ts", "seq"], "v", initial=None, hot=hot).select("v", "diff")
    assert rows(t2) == [(23.0, 2.0)]


def test_value_change_expires(spark, hot):
    df = events(spark, [("a", 0, 20.0), ("a", 3600, 25.0), ("a", 7201, 20.0)], "id string, ts int, v double")
    out = stateful.value_change(df, "id", ["ts", "seq"], "v", expire="1 hour", hot=hot).orderBy("ts")
    assert [(r.v, r.diff) for r in out.collect()] == [(20.0, 20.0), (25.0, 5.0), (20.0, 20.0)]


def test_rise_alert(spark, hot):
    data = [("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 1.5, 2.0), ("a", 2.5, 3.0), ("a", 4.0, 1.0)]
    out = stateful.rise_alerts(events(spark, data, "id string, ts double, v double"), "id", ["ts", "seq"], "v", hot=hot)
    assert rows(seconds(out, "alert_at")) == [("a", 2.0)]


def test_anchored_windows(spark, hot):
    df = events(spark, [("a", t) for t in (0, 4, 10, 11, 30)], "id string, ts int")
    out = stateful.anchored_windows(df, ["id"], "ts", "10 seconds", hot=hot).orderBy("anchor")
    assert [r["count"] for r in out.collect()] == [3, 1, 1]


def test_timers(spark):
    df = events(spark, [("a", 1), ("a", 1), ("b", 2)], "id string, ts int")
    assert rows(seconds(stateful.event_timers(df, "id", "ts"), "fire_at").select("id", "fire_at")) == [("a", 10.999), ("b", 11.999)]
    assert rows(seconds(stateful.forward_with_timer(df, "ts"), "fire_at").select("fire_at")) == [(11.0,), (11.0,), (12.0,)]


def test_login_failures(spark, hot):
    data = [("1", "fail", 1), ("1", "success", 2), ("1", "fail", 3), ("1", "fail", 4)]
    df = events(spark, data, "u string, k string, ts int")
    out = stateful.login_failures(df, "u", ["ts", "seq"], "k", hot=hot)
    assert rows(seconds(out, "alert_at")) == [("1", 8.0)]


def test_order_timeouts(spark, hot):
    data = [("1", "create", 2), ("2", "create", 3), ("2", "pay", 4), ("3", "create", 0), ("3", "pay", 5)]
    df = events(spark, data, "o string, k string, ts int")
    out = stateful.order_timeouts(df, "o", "ts", "k", "seq", hot=hot)
    assert rows(seconds(out, "created_at", "timeout_at")) == [("1", 2.0, 7.0)]


def test_pattern_times(spark, hot):
    data = [("1", "fail", 842), ("1", "fail", 843), ("1", "fail", 844), ("2", "success", 845)]
    df = events(spark, data, "u string, k string, ts int")
    fail = F.col("k") == "fail"
    assert rows(match(df, Pattern.begin("f", fail).times(3), "u", ["ts", "seq"], hot=hot).select("u")) == [("1",)]
    strict = Pattern.begin("a", fail).next("b", fail).next("c", fail)
    assert match(df, strict.within("10 seconds"), "u", ["ts", "seq"], hot=hot).count() == 1
    assert match(df, strict.within("2 seconds"), "u", ["ts", "seq"], hot=hot).count() == 0


def test_pattern_order_timeout(spark, hot):
    data = [("1", "create", 2), ("2", "create", 3), ("2", "pay", 4), ("3", "create", 0), ("3", "pay", 5),
            ("4", "create", 0), ("4", "create", 1), ("4", "pay", 2)]
    df = events(spark, data, "o string, k string, ts int")
    pattern = Pattern.begin("create", F.col("k") == "create").next("pay", F.col("k") == "pay").within("5 seconds")
    out = match(df, pattern, "o", ["ts", "seq"], timeouts=True, hot=hot)
    assert rows(out.select("o", "output")) == [("1", "timeout"), ("2", "matched"), ("3", "timeout"), ("4", "matched")]


def test_early_firing(spark):
    df = events(spark, [("a", 0.2), ("a", 0.9), ("a", 3.5)], "id string, ts double")
    out = seconds(early_firing(df, ["id"], "ts", "5 seconds", "1 second"), "fired_at").select("fired_at", "count")
    assert rows(out) == [(1.0, 2), (2.0, 2), (3.0, 2), (4.0, 3), (5.0, 3)]


def arrivals(spark, data):
    return at(spark.createDataFrame([(i, "a", float(t)) for i, t in enumerate(data)], "seq long, k string, ts double"), "ts")


def test_late_for_window(spark, hot):
    out = late.late_for_window(arrivals(spark, [1, 12, 5]), ["seq"], "ts", "10 seconds", hot=hot).orderBy("seq")
    assert [r.output for r in out.collect()] == ["main", "main", "late"]


def test_late_record(spark, hot):
    out = late.late_records(arrivals(spark, [5, 3, 5, 9, 6]), ["seq"], "ts", hot=hot).orderBy("seq")
    assert [r.output for r in out.collect()] == ["main", "late", "main", "main", "late"]


def test_updating_windows(spark, hot):
    df = arrivals(spark, [1, 11, 2, 20, 3])
    out = late.updating_windows(df, ["k"], ["seq"], "ts", hot=hot)
    first = seconds(out, "window_end").filter("window_end = 5").select("is_update", "count")
    assert rows(first) == [(False, 1), (True, 2)]


def test_first_firing_by_a_late_record(spark, hot):
    df = arrivals(spark, [11, 2])
    out = seconds(late.updating_windows(df, ["k"], ["seq"], "ts", hot=hot), "window_end").filter("window_end = 5")
    assert rows(out.select("fired_by", "is_update", "count")) == [(1, False, 1)]


def test_window_apply(spark):
    df = events(spark, [("a", 0.0, 1.0), ("a", 1.0, 3.0), ("a", 6.0, 5.0)], "id string, ts double, v double")

    def spread(rows):
        return rows.iloc[:1][["id"]].assign(spread=rows.v.max() - rows.v.min())

    assert rows(windows.window_apply(df, ["id"], "ts", "5 seconds", spread, "id string, spread double")) == [("a", 0.0), ("a", 2.0)]
