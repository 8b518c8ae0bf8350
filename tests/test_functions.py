"""String functions, parsers, sources and option builders."""

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import strings, user
from tidemark.sinks import kafka as kafka_sink
from tidemark.sources import kafka as kafka_source
from tidemark.sources import lines, tables


def java_hash(text, multiplier=31):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * multiplier + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_java_split(spark):
    df = spark.createDataFrame([(1, ""), (2, "   "), (3, "a  b  "), (4, " a")], "i int, s string")
    out = df.select("i", strings.java_split(F.col("s"), r"\s").alias("p")).orderBy("i")
    assert [r.p for r in out.collect()] == [[""], [], ["a", "", "b"], ["", "a"]]


def test_hash_code(spark):
    texts = ["hello", "sensor_10", "", "😀 wide", "é" * 50, "x" * 5000, "a\nb", "polygenelubricants"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = {r.s: r.h for r in df.select("s", strings.hash_code(F.col("s")).alias("h")).collect()}
    assert got["hello"] == 99162322 and got["sensor_10"] == 470860996 and got[""] == 0
    assert got == {t: java_hash(t) for t in texts}
    strings.register_hash_code(spark, "hash_times_ten", 10)
    df.createOrReplaceTempView("hash_texts")
    sql = {r.s: r.h for r in spark.sql("SELECT s, hash_times_ten(s) AS h FROM hash_texts").collect()}
    wrap = lambda v: (v + (1 << 31)) % (1 << 32) - (1 << 31)
    assert sql == {t: wrap(java_hash(t) * 10) for t in texts}
    ten = {r.s: r.h for r in df.select("s", strings.hash_code(F.col("s"), 10).alias("h")).collect()}
    assert ten == sql
    arrow = df.select("s", strings.hash_code_of_texts(10)("s").alias("h"))
    assert {r.s: r.h for r in arrow.collect()} == sql


def test_visitor_bucket(spark):
    df = spark.createDataFrame([(123,), (561558,)], "u long")
    assert [r.b for r in df.select(strings.visitor_bucket(F.col("u")).alias("b")).collect()] == [86, 210]


def test_utf16_length(spark):
    df = spark.createDataFrame([("abc",), ("😀",), ("",)], "s string")
    assert [r.n for r in df.select(strings.utf16_length(F.col("s")).alias("n")).collect()] == [3, 2, 0]


def test_average_function(spark):
    user.register_average(spark)
    spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0)], "k string, v double").createOrReplaceTempView("vals")
    assert rows(spark.sql("SELECT k, avg_of(sum(v), count(v)) AS m FROM vals GROUP BY k")) == [("a", 1.5), ("b", 4.0)]


def test_behavior_lines(spark, tmp_path):
    path = tmp_path / "behavior.csv"
    path.write_text("543462,1715,1464116,pv,1511658000\nbad line\n1,2,x,pv,3\n")
    parsed = lines.read_behavior(spark, str(path))
    good = lines.good(parsed)
    assert rows(good.withColumn("ts", F.unix_seconds("ts"))) == [(543462, 1715, 1464116, "pv", 1511658000)]
    assert rows(lines.bad(parsed)) == [("1,2,x,pv,3",), ("bad line",)]


def test_weblog_lines(spark):
    stamps = ["17/05/2015:10:05:03", "1/05/2015:10:05:03", "32/05/2015:10:05:03"]
    df = spark.createDataFrame([(f"83.1.2.3 - 42 {s} +0000 GET /page?x=1",) for s in stamps], "value string")
    parsed = lines.parse_weblog(df)
    good = lines.good(parsed).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    assert rows(good) == [
        ("83.1.2.3", "42", "2015-05-01 10:05:03", "GET", "/page?x=1"),
        ("83.1.2.3", "42", "2015-05-17 10:05:03", "GET", "/page?x=1"),
    ]
    assert lines.bad(parsed).count() == 1


def test_keyed_lines(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a 1\nb 20\nc\n")
    parsed = lines.read_keyed(spark, str(tmp_path))
    assert rows(lines.good(parsed).withColumn("ts", F.unix_seconds("ts"))) == [("a", 1), ("b", 20)]
    assert rows(lines.bad(parsed)) == [("c",)]


def test_keyed_lines_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("a 1\nb 20\n")
    stream = lines.good(lines.read_keyed(spark, str(folder), stream=True))
    query = stream.writeStream.format("memory").queryName("keyed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("keyed").count() == 2


def test_csv_table(spark, tmp_path):
    path = tmp_path / "sensor.txt"
    path.write_text("sensor_1,1,1.1\nsensor_2,2,2.2\n")
    table = tables.csv_table(spark, "sensor_csv", "id STRING, ts BIGINT, temperature DOUBLE", str(path))
    assert rows(table.select("id", "ts")) == [("sensor_1", 1), ("sensor_2", 2)]
    assert dict(table.dtypes)["pt"] == "timestamp"


def test_table_from(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "id string, n int, t double")
    out = tables.table_from(df, sensor=F.col("id"), temp=F.col("t"))
    assert out.columns == ["sensor", "temp"] and rows(out) == [("a", 2.0)]


def test_kafka_options(spark):
    assert kafka_source.kafka_options("h:9092", "hot") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "hot", "startingOffsets": "latest",
    }
    assert kafka_source.kafka_options("h:9092", "hot", "g")["kafka.group.id"] == "g"
    assert kafka_sink.writer_options("h:9092", "out") == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}
    messages = spark.createDataFrame([(bytearray(b"1,2,3,pv,4"),)], "value binary")
    parsed = lines.good(lines.parse_behavior(kafka_source.message_text(messages)))
    assert rows(parsed.select("user_id", "behavior")) == [(1, "pv")]
    assert rows(kafka_sink.messages(parsed, "item_id")) == [("2",)]


def test_batched_hash_of_all_kinds_of_texts(spark):
    texts = ["", None, "a", "é", "😀x😀", "日本語", "", "z" * 5000, None, "end", "\u0000"]

    def plain(text, factor=10):
        h = 0
        data = text.encode("utf-16-be")
        for i in range(0, len(data), 2):
            h = (h * 31 + int.from_bytes(data[i : i + 2])) % 2**32
        h = h * factor % 2**32
        return h - 2**32 if h >= 2**31 else h

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = {r.i: r.h for r in df.select("i", strings.hash_code_of_texts(10)("t").alias("h")).collect()}
    assert got == {i: None if t is None else plain(t) for i, t in enumerate(texts)}
    assert df.limit(0).select(strings.hash_code_of_texts()("t")).collect() == []
    nothing = df.filter("t IS NULL").select(strings.hash_code_of_texts()("t").alias("h")).collect()
    assert [r.h for r in nothing] == [None, None]


def test_lateral_in_sql_stays_in_the_jvm(spark, capsys):
    user.register_split_words(spark, "split_marks", "[?#]")
    rows = [(1, "a#b?"), (2, ""), (3, "##"), (4, None), (5, "#x")]
    spark.createDataFrame(rows, "id int, s string").createOrReplaceTempView("marked")
    cross = spark.sql("SELECT id, word, length FROM marked m, LATERAL split_marks(m.s)")
    left = spark.sql("SELECT id, word, length FROM marked m LEFT JOIN LATERAL split_marks(m.s) ON true")
    want = [(1, "a", 1), (1, "b", 1), (2, "", 0), (5, "", 0), (5, "x", 1)]
    key = lambda r: (r[0], str(r[1]))
    assert sorted((tuple(r) for r in cross.collect()), key=key) == want
    assert sorted((tuple(r) for r in left.collect()), key=key) == sorted([*want, (3, None, None), (4, None, None)], key=key)
    capsys.readouterr()
    left.explain()
    assert "Python" not in capsys.readouterr().out


def test_flat_aggregate(spark):
    data = [("a", 3, "x"), ("a", None, "y"), ("a", 5, "z"), ("b", 1, "x"), (None, 7, "x"), ("c", None, "x")]
    df = spark.createDataFrame(data, "k string, _state int, _row string")

    def ends(s):
        def end(name):
            return F.when(s[name].isNotNull(), F.struct(F.lit(name).alias("place"), s[name].alias("value"), s["n"].alias("n")))

        return F.when(s["n"] > 0, F.array(end("lo"), F.when(s["hi"] > s["lo"], end("hi"))))

    state = {"lo": F.min("_state"), "hi": F.max("_state"), "n": F.count("_state")}
    got = user.flat_aggregate(df, ["k"], state, ends)
    assert got.columns == ["k", "place", "value", "n"]
    want = [(None, "lo", 7, 1), ("a", "hi", 5, 2), ("a", "lo", 3, 2), ("b", "lo", 1, 1)]
    assert sorted(rows(got), key=str) == sorted(want, key=str)
    assert rows(user.flat_aggregate(df, [], state, ends).orderBy("place")) == [("hi", 7, 4), ("lo", 1, 4)]
    assert rows(user.flat_aggregate(df.limit(0), ["k"], state, ends)) == []
    renamed = user.flat_aggregate(df.withColumnRenamed("k", "_row2"), ["_row2"], state, ends)
    assert renamed.count() == 4
    assert sorted(rows(user.flat_aggregate(df, ["_row"], state, ends)))[0] == ("x", "hi", 7, 3)


def test_flat_aggregate_in_part_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = user.flat_aggregate(df, ["k"], {"top": F.max("id")}, lambda s: F.array(F.struct(s["top"].alias("top"))))
    plan = out._jdf.queryExecution().toString()
    assert "partial_max" in plan and "Python" not in plan
    assert rows(out.orderBy("k")) == [(0, 99), (1, 97), (2, 98)]


def test_long_texts_hash_in_the_memory_of_a_piece(spark, monkeypatch):
    """Thirty times as much text takes no more working memory, and pieces of any size give the same hashes."""
    import tracemalloc

    import pyarrow as pa

    words = ["the sea and ", "ÄÖ😀 ", "日本語 ", "x"]
    hashes, peaks = strings.hash_code_of_texts(10).func, []
    for copies in (1, 30):
        texts = pa.array([words[i % 4] * 20_000 for i in range(10)] * copies)
        tracemalloc.start()
        found = hashes(texts)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found.to_pylist() == found[:10].to_pylist() * copies
    assert peaks[1] < 1.5 * peaks[0]
    mixed = pa.array([None, "", *[w * n for w in words for n in (1, 7, 300)], None, ""])
    whole = hashes(mixed).to_pylist()
    for size in (4, 16, 100):
        monkeypatch.setattr(strings, "PIECE_BYTES", size)
        assert hashes(mixed).to_pylist() == whole and hashes(mixed.slice(2, 9)).to_pylist() == whole[2:11]
