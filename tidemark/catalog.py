"""Every operator as a named query over the given tables, with the same query in plain SQL.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame`` and ``ORACLES`` to SQL for DuckDB over
the same tables. The reference durations are seconds; the tables hold a few events per user and
day, so the queries pass durations that fit them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import strings, user
from tidemark.operators import basic, joins, late, rank, rolling, stateful, visitors, windows
from tidemark.operators.patterns import Pattern, match
from tidemark.session import shared_dir
from tidemark.sinks import documents, keyed
from tidemark.sinks.streams import to_table
from tidemark.sources import lines, tables
from tidemark.streaming import folds, operators, processors
from tidemark.streaming import patterns as stream_patterns
from tidemark.streaming import windows as stream_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ORDER = ["ts", "event_id"]

SENSOR = "(SELECT event_id, CAST(user_id AS varchar) AS id, ts, value AS temperature FROM events)"
BEHAVIOR = (
    "(SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS bigint) AS item_id,"
    " event_type AS behavior, ts FROM events)"
)
ARRIVALS = (
    "(SELECT event_id, CAST(user_id AS varchar) AS id, event_type, ts, value AS temperature,"
    " ts + ((event_id * 37) % 20) * INTERVAL 30 MINUTE AS arrival FROM events)"
)
MINUTE, HOUR, DAY = 60_000_000, 3_600_000_000, 86_400_000_000


def query(oracle: str | None = None):
    """Register a function under its own name."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return add


def start(ts: str, size: int) -> str:
    """Start of the tumbling window in SQL, by epoch arithmetic."""
    return f"make_timestamp((epoch_us({ts}) // {size}) * {size})"


def end(ts: str, size: int) -> str:
    return f"make_timestamp((epoch_us({ts}) // {size}) * {size} + {size})"


def hops(source: str, size: int, slide: int) -> str:
    """Each row once per sliding window it is in, as ``window_end``."""
    return (
        f"(SELECT s.*, make_timestamp((epoch_us(ts) // {slide} - j + {size // slide}) * {slide}) AS window_end"
        f" FROM {source} s, range({size // slide}) r(j))"
    )


def _events(spark, sf_dir):
    return model.table(spark, sf_dir, "events")


def _sensor(spark, sf_dir):
    return model.sensor_readings(_events(spark, sf_dir))


def _behavior(spark, sf_dir):
    return model.user_behavior(_events(spark, sf_dir))


def _arrivals(spark, sf_dir):
    return model.arrivals(_events(spark, sf_dir))


def _view(df: DataFrame, name: str) -> str:
    return tables.as_view(df, f"{name}_{uuid.uuid4().hex[:12]}")


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


# --- sources -------------------------------------------------------------------------------


@query(
    f"""SELECT user_id, item_id, CAST(item_id % 10 AS int) AS category_id, behavior,
               date_trunc('second', ts) AS ts FROM {BEHAVIOR}"""
)
def src_behavior_csv(spark, sf_dir):
    return _ntz(lines.good(lines.parse_behavior(model.behavior_lines(_events(spark, sf_dir)))), "ts")


@query(
    f"""SELECT '10.0.0.' || (e.user_id % 256) AS ip, CAST(e.user_id AS varchar) AS user_id,
               date_trunc('second', e.ts) AS ts,
               CASE WHEN behavior = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
               '/item/' || item_id AS url FROM {BEHAVIOR} e"""
)
def src_weblog_parse(spark, sf_dir):
    return _ntz(lines.good(lines.parse_weblog(model.weblog_lines(_events(spark, sf_dir)))), "ts")


@query("SELECT CAST(user_id AS varchar) AS key, date_trunc('second', ts) AS ts FROM events")
def src_keyed_lines(spark, sf_dir):
    return _ntz(lines.good(lines.parse_keyed(model.keyed_lines(_events(spark, sf_dir)))), "ts")


@query("SELECT CAST(user_id AS varchar) AS id, epoch_us(ts) // 1000000 AS ts FROM events")
def ddl_csv_table(spark, sf_dir):
    readings = _sensor(spark, sf_dir).withColumn("ts", F.unix_seconds(F.col("ts").cast("timestamp")))
    path = shared_dir(spark, "sensor-csv")
    readings.select("id", "ts", "temperature").write.csv(path)
    name = f"sensor_{uuid.uuid4().hex[:12]}"
    return tables.csv_table(spark, name, "id STRING, ts BIGINT, temperature DOUBLE", path).select("id", "ts")


@query(f"SELECT id AS sensor, ts, temperature AS temp FROM {SENSOR}")
def table_from_stream(spark, sf_dir):
    return tables.table_from(
        _sensor(spark, sf_dir), sensor=F.col("id"), ts=F.col("ts"), temp=F.col("temperature")
    )


# --- sinks ---------------------------------------------------------------------------------


@query(
    f"""SELECT id, event_id, ts, temperature FROM (SELECT *, row_number() OVER
        (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM {SENSOR}) WHERE rn = 1"""
)
def sink_upsert_latest(spark, sf_dir):
    return keyed.latest_per_key(_sensor(spark, sf_dir), ["id"], ORDER)


@query(
    f"""SELECT event_id, 'sensor' AS index, (row_number() OVER (ORDER BY event_id) - 1) // 10 AS bulk,
        '{{"id":"' || id || '","ms":"' || (epoch_us(ts) // 1000) || '","temperature":"' || temperature || '"}}'
        AS document FROM {SENSOR}"""
)
def sink_index_docs(spark, sf_dir):
    readings = _sensor(spark, sf_dir).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return documents.index_documents(readings, "sensor", ["id", "ms", "temperature"], ["event_id"])


@query(
    f"""SELECT 'sensor_temperature' AS hash, id AS field, CAST(arg_max(temperature, (ts, event_id)) AS varchar)
        AS value FROM {SENSOR} GROUP BY id"""
)
def sink_hash_latest(spark, sf_dir):
    return keyed.hash_rows(_sensor(spark, sf_dir), "id", "temperature", ORDER)


@query(
    f"""WITH r AS (SELECT *, min(item_id) OVER w AS x, max(item_id) OVER w AS y
                   FROM {BEHAVIOR} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
             c AS (SELECT *, lag(x) OVER w AS ox, lag(y) OVER w AS oy FROM r
                   WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT user_id, ts, event_id, 1 AS change, true AS is_add, x, y FROM c
        WHERE ox IS NULL OR x <> ox OR y <> oy
        UNION ALL
        SELECT user_id, ts, event_id, 0, false, ox, oy FROM c WHERE x <> ox OR y <> oy"""
)
def retract_changelog(spark, sf_dir):
    return rolling.retract_changelog(_behavior(spark, sf_dir), ["user_id"], ORDER, "item_id")


# --- projections, filters, fan-outs --------------------------------------------------------


@query("SELECT CAST(user_id AS varchar) AS id FROM events")
def project_id(spark, sf_dir):
    return basic.project(_sensor(spark, sf_dir), "id")


@query("SELECT event_id + 1 AS event_id FROM events")
def map_plus_one(spark, sf_dir):
    return basic.plus(_events(spark, sf_dir).select("event_id"), "event_id")


@query("SELECT event_id, user_id, ts, value FROM events WHERE user_id = 8")
def filter_key(spark, sf_dir):
    return basic.only(_events(spark, sf_dir).select("event_id", "user_id", "ts", "value"), "user_id", 8)


@query(f"SELECT event_id, user_id, item_id, ts FROM {BEHAVIOR} WHERE behavior = 'view'")
def filter_behavior(spark, sf_dir):
    views = basic.only(_behavior(spark, sf_dir), "behavior", "view")
    return views.select("event_id", "user_id", "item_id", "ts")


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, CAST(copy AS int) AS copy FROM lineitem,
       LATERAL (SELECT unnest(range(1, CASE l_linenumber WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 1 END)) AS copy)"""
)
def flatmap_repeat(spark, sf_dir):
    items = model.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    n = F.col("l_linenumber")
    return basic.repeat_rows(items, F.when(n == 2, 1).when(n == 3, 2).otherwise(0))


@query(
    """SELECT doc_id, unnest(range(len(p))) AS pos, unnest(p) AS word FROM
       (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS p FROM documents)"""
)
def tokenize_space(spark, sf_dir):
    docs = model.table(spark, sf_dir, "documents").select("doc_id", "text")
    return basic.tokenize(docs, "text", " ").withColumn("pos", F.col("pos").cast("bigint"))


@query(
    """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS label FROM orders"""
)
def split_select(spark, sf_dir):
    orders = model.table(spark, sf_dir, "orders")
    label = F.when(F.col("o_totalprice") > 250000, "large").otherwise("small")
    return basic.select_parts(basic.label_parts(orders, label), "small", "large").select("o_orderkey", "label")


@query("SELECT o_orderkey, 'large' AS label FROM orders WHERE o_totalprice > 250000")
def split_select_one(spark, sf_dir):
    orders = model.table(spark, sf_dir, "orders")
    label = F.when(F.col("o_totalprice") > 250000, "large").otherwise("small")
    return basic.select_parts(basic.label_parts(orders, label), "large").select("o_orderkey", "label")


@query(
    f"""SELECT event_id, id, temperature, 'main' AS output, NULL::varchar AS message FROM {SENSOR}
        UNION ALL SELECT event_id, id, temperature, 'frost', 'frost at ' || id
        FROM {SENSOR} WHERE temperature < 32.0"""
)
def side_output_alarm(spark, sf_dir):
    readings = _sensor(spark, sf_dir).select("event_id", "id", "temperature")
    text = F.concat(F.lit("frost at "), F.col("id"))
    return basic.side_output(readings, F.col("temperature") < 32.0, "frost", text)


@query(f"SELECT id, temperature FROM {SENSOR}")
def table_select(spark, sf_dir):
    return spark.sql(f"SELECT id, temperature FROM {_view(_sensor(spark, sf_dir), 'sensor')}")


# --- rolling aggregations ------------------------------------------------------------------


@query(
    f"""SELECT event_id, user_id, CAST(sum(item_id) OVER w AS bigint) AS item_id, first(behavior) OVER w AS behavior
        FROM {BEHAVIOR} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def rolling_sum(spark, sf_dir):
    rows = rolling.rolling_sum(_behavior(spark, sf_dir), ["user_id"], ORDER, "item_id", ["behavior"])
    return rows.select("event_id", "user_id", "item_id", "behavior")


@query(
    """WITH w AS (SELECT doc_id, unnest(range(len(p))) AS pos, unnest(p) AS word FROM
                  (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS p FROM documents))
       SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos) AS count FROM w"""
)
def rolling_word_count(spark, sf_dir):
    docs = model.table(spark, sf_dir, "documents").select("doc_id", "text")
    words = basic.tokenize(docs, "text", " ").withColumn("pos", F.col("pos").cast("bigint"))
    return rolling.rolling_count(words, ["word"], ["doc_id", "pos"])


@query(
    f"""SELECT event_id, id, min(temperature) OVER
        (PARTITION BY id ORDER BY ts, event_id) AS temperature FROM {SENSOR}"""
)
def rolling_min(spark, sf_dir):
    rows = rolling.rolling_min(_sensor(spark, sf_dir), ["id"], ORDER, "temperature")
    return rows.select("event_id", "id", "temperature")


@query(
    f"""SELECT event_id, id, first(ts) OVER w AS first_ts, min(temperature) OVER w AS temperature
        FROM {SENSOR} WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)"""
)
def rolling_reduce_min(spark, sf_dir):
    readings = _sensor(spark, sf_dir).withColumn("first_ts", F.col("ts"))
    rows = rolling.rolling_min(readings, ["id"], ORDER, "temperature", ["first_ts"])
    return rows.select("event_id", "id", "first_ts", "temperature")


@query(
    """SELECT conv_id, turn, string_agg(role, ',') OVER (PARTITION BY conv_id ORDER BY turn) AS roles
       FROM conversations"""
)
def rolling_list_concat(spark, sf_dir):
    turns = model.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array("role").alias("roles"))
    lists = rolling.rolling_concat(turns, ["conv_id"], ["turn"], "roles")
    return lists.withColumn("roles", F.concat_ws(",", "roles"))


@query(
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) - 1 AS place, word AS element,
              count(*) OVER (PARTITION BY conv_id ORDER BY turn) AS size
       FROM (SELECT conv_id, turn, unnest(range(len(p))) AS pos, unnest(p) AS word FROM
             (SELECT conv_id, turn, string_split(text, ' ') AS p FROM conversations))"""
)
def rolling_list_places(spark, sf_dir):
    turns = model.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", " ").alias("words"))
    return rolling.rolling_elements(turns, ["conv_id"], ["turn"], "words")


# --- windows -------------------------------------------------------------------------------


@query(
    f"""SELECT id, {start('ts', DAY)} AS window_start, round(avg(temperature), 6) AS avg_temp
        FROM {SENSOR} GROUP BY 1, 2"""
)
def tumble_avg(spark, sf_dir):
    mean = F.round(F.avg("temperature"), 6).alias("avg_temp")
    return windows.tumbling(_sensor(spark, sf_dir), ["id"], "ts", "1 day", mean).drop("window_end")


@query(
    f"""SELECT id, {end('ts', DAY)} AS window_end, round(avg(temperature), 6) AS avg_temp
        FROM {SENSOR} GROUP BY 1, 2"""
)
def tumble_avg_end(spark, sf_dir):
    mean = F.round(F.avg("temperature"), 6).alias("avg_temp")
    return windows.tumbling(_sensor(spark, sf_dir), ["id"], "ts", "1 day", mean).drop("window_start")


@query(
    f"""SELECT id, {end('ts', DAY)} AS window_end, min(temperature) AS min_temp, max(temperature) AS max_temp
        FROM {SENSOR} GROUP BY 1, 2"""
)
def tumble_min_max(spark, sf_dir):
    low, high = F.min("temperature").alias("min_temp"), F.max("temperature").alias("max_temp")
    return windows.tumbling(_sensor(spark, sf_dir), ["id"], "ts", "1 day", low, high).drop("window_start")


@query(f"SELECT id, window_end, min(temperature) AS min_value FROM {hops(SENSOR, 6 * HOUR, HOUR)} GROUP BY 1, 2")
def slide_min(spark, sf_dir):
    found = windows.sliding_min(_sensor(spark, sf_dir), ["id"], "ts", "temperature", "6 hours", "1 hour")
    return found.drop("window_start")


@query(f"SELECT id, {end('ts', DAY)} AS window_end, count(*) AS count FROM {SENSOR} GROUP BY 1, 2")
def tumble_count(spark, sf_dir):
    n = F.count(F.lit(1)).alias("count")
    return windows.tumbling(_sensor(spark, sf_dir), ["id"], "ts", "1 day", n).drop("window_start")


@query(
    f"""WITH w AS (SELECT make_timestamp(doc_id * 1000000) AS ts,
                          unnest(string_split_regex(regexp_replace(text, '\\s+$', ''), '\\s')) AS word FROM documents)
        SELECT word, {start('ts', MINUTE)} AS window_start, count(*) AS count FROM w GROUP BY 1, 2"""
)
def word_count_window(spark, sf_dir):
    docs = model.table(spark, sf_dir, "documents")
    timed = docs.select(F.timestamp_seconds("doc_id").cast("timestamp_ntz").alias("ts"), "text")
    return windows.word_counts(basic.tokenize(timed, "text", r"\s"), size="1 minute").drop("window_end")


MARKETING = (
    f"(SELECT *, CASE WHEN item_id % 2 = 0 THEN 'north' ELSE 'south' END AS channel"
    f" FROM {BEHAVIOR} WHERE behavior <> 'error')"
)


@query(
    f"""SELECT channel, window_end, count(*) AS count FROM {hops(MARKETING, 6 * HOUR, HOUR)}
        GROUP BY channel, behavior, window_end"""
)
def marketing_by_channel(spark, sf_dir):
    found = windows.marketing_by_channel(model.marketing(_events(spark, sf_dir)), "6 hours", "1 hour", "error")
    return found.select("channel", "window_end", "count")


@query(f"SELECT window_end, count(*) AS count FROM {hops(MARKETING, 6 * HOUR, HOUR)} GROUP BY window_end")
def marketing_total(spark, sf_dir):
    found = windows.marketing_total(model.marketing(_events(spark, sf_dir)), "6 hours", "1 hour", "error")
    return found.select("window_end", "count")


@query(f"SELECT DISTINCT id, {end('ts', DAY)} AS window_end, 'hello world' AS text FROM {SENSOR}")
def window_presence(spark, sf_dir):
    return windows.presence(_sensor(spark, sf_dir), ["id"], "ts", "1 day").drop("window_start")


@query(
    f"""WITH s AS (SELECT id, ts, {end('ts', DAY)} AS window_end FROM {SENSOR}),
             g AS (SELECT id, window_end, min(ts) AS first_ts FROM s GROUP BY 1, 2),
             b AS (SELECT id, window_end, first_ts, window_end - j * INTERVAL 4 HOUR AS fired_at FROM g, range(6) r(j))
        SELECT b.id, b.window_end, b.fired_at, count(*) AS count FROM b JOIN s
        ON s.id = b.id AND s.window_end = b.window_end AND s.ts < b.fired_at
        WHERE b.first_ts < b.fired_at GROUP BY 1, 2, 3"""
)
def window_early_fire(spark, sf_dir):
    return windows.early_firing(_sensor(spark, sf_dir), ["id"], "ts", "1 day", "4 hours")


# --- joins and two inputs ------------------------------------------------------------------


@query("SELECT event_id, user_id, ts FROM events WHERE user_id IN (1, 2, 3)")
def union_three(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    return basic.union_all(*[basic.only(rows, "user_id", u) for u in (1, 2, 3)])


@query(
    """SELECT o_orderkey AS key, 'key ' || o_orderkey || ' from the first input' AS value FROM orders
       UNION ALL SELECT l_orderkey, 'key ' || l_orderkey || ' from the second input' FROM lineitem"""
)
def connect_comap(spark, sf_dir):
    one = model.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_totalprice")
    two = model.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), "l_returnflag")
    text = [F.concat(F.lit("key "), F.col("key"), F.lit(f" from the {n} input")) for n in ("first", "second")]
    return basic.co_map(basic.connect(one, two), ["key"], *text)


@query(
    """SELECT c_custkey AS key, 1 AS copy, c_name AS value FROM customer
       UNION ALL SELECT s_suppkey, j, s_name FROM supplier, range(1, 3) r(j)"""
)
def connect_coflatmap(spark, sf_dir):
    one = model.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    two = model.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    both = basic.connect(one, two)
    out = basic.co_flat_map(both, ["key"], F.col("c_name"), F.col("s_name"), 1, 2)
    return out.withColumn("copy", F.col("copy").cast("bigint"))


@query(
    f"""WITH s AS (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS source FROM {ARRIVALS}),
             m AS (SELECT event_id, source,
                     max(ts) FILTER (source = 1) OVER w - INTERVAL 1 HOUR AS first_watermark,
                     max(ts) FILTER (source = 2) OVER w - INTERVAL 10 HOUR AS second_watermark
                   FROM s WINDOW w AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT *, CASE WHEN first_watermark IS NOT NULL AND second_watermark IS NOT NULL
                       THEN least(first_watermark, second_watermark) END AS watermark FROM m"""
)
def two_input_watermark(spark, sf_dir):
    events = _events(spark, sf_dir)
    kinds = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(2)
    wait = ((F.col("event_id") * 37) % 20) * F.expr("INTERVAL 30 MINUTE")
    rows = events.select("event_id", kinds.alias("source"), "ts", (F.col("ts") + wait).alias("arrival"))
    seen = joins.two_input_watermark(rows, "source", ["arrival", "event_id"], "ts", ("1 hour", "10 hours"))
    return seen.drop("arrival", "ts")


@query(
    f"""SELECT DISTINCT r.event_id, r.user_id, r.ts, r.value FROM events r JOIN
        (SELECT user_id, ts, (item_id + 1) * INTERVAL 1 MINUTE AS d FROM {BEHAVIOR} WHERE behavior = 'signup') s
        ON r.user_id = s.user_id AND r.ts BETWEEN s.ts AND s.ts + s.d WHERE r.event_type <> 'signup'"""
)
def switch_filter(spark, sf_dir):
    events = _events(spark, sf_dir)
    readings = basic.without(events, "event_type", "signup").select("event_id", "user_id", "ts", "value")
    return joins.switch_filter(readings, model.switches(events), "user_id", "ts", "duration", "event_id")


@query(
    """SELECT o_orderkey AS orderkey, o_orderdate, l_linenumber, l_shipdate FROM orders JOIN lineitem
       ON o_orderkey = l_orderkey
       AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY"""
)
def interval_join(spark, sf_dir):
    orders = model.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    items = model.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate"
    )
    return joins.interval_join(orders, items, ["orderkey"], "o_orderdate", "l_shipdate", "-30 days", "30 days")


@query(
    f"""SELECT a.user_id, {start('a.ts', DAY)} AS window_start, a.event_id AS click_id, b.event_id AS purchase_id
        FROM events a JOIN events b ON a.user_id = b.user_id AND {start('a.ts', DAY)} = {start('b.ts', DAY)}
        WHERE a.event_type = 'click' AND b.event_type = 'purchase'"""
)
def window_join(spark, sf_dir):
    events = _events(spark, sf_dir)
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("ts").alias("a"), F.col("event_id").alias("click_id"))
    buys = events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("b"), F.col("event_id").alias("purchase_id"))
    return joins.window_join(clicks, buys, ["user_id"], "a", "b", "1 day").drop("a", "b")


@query(
    """WITH p AS (SELECT l_orderkey AS k, min(l_shipdate) AS pay_at FROM lineitem GROUP BY 1),
            m AS (SELECT o_orderkey, o_orderdate, pay_at FROM orders JOIN p ON k = o_orderkey
                  AND pay_at BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY)
       SELECT o_orderkey AS orderkey, o_orderdate AS order_at, pay_at, 'matched' AS output FROM m
       UNION ALL SELECT o_orderkey, o_orderdate, NULL, 'unmatched_order' FROM orders
       WHERE o_orderkey NOT IN (SELECT o_orderkey FROM m)
       UNION ALL SELECT k, NULL, pay_at, 'unmatched_pay' FROM p WHERE k NOT IN (SELECT o_orderkey FROM m)"""
)
def reconcile_outer(spark, sf_dir):
    orders = model.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    items = model.table(spark, sf_dir, "lineitem")
    pays = items.groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    return joins.reconcile(orders, pays, "orderkey", "o_orderdate", "shipped", "30 days")


# --- keyed state and timers ----------------------------------------------------------------

LAGGED = (
    f"(SELECT *, lag(temperature) OVER w AS p, lag(ts) OVER w AS pts FROM {SENSOR}"
    " WINDOW w AS (PARTITION BY id ORDER BY ts, event_id))"
)


@query(
    f"""SELECT event_id, id, temperature, round(abs(temperature - coalesce(p, 0.0)), 6) AS diff FROM {LAGGED}
        WHERE abs(temperature - coalesce(p, 0.0)) > 1.7"""
)
def temp_diff(spark, sf_dir):
    return _changes(stateful.value_change(_sensor(spark, sf_dir), "id", ORDER, "temperature"))


@query(
    f"""SELECT event_id, id, temperature, round(abs(temperature - p), 6) AS diff FROM {LAGGED}
        WHERE abs(temperature - p) > 1.7"""
)
def temp_diff_first_silent(spark, sf_dir):
    return _changes(stateful.value_change(_sensor(spark, sf_dir), "id", ORDER, "temperature", initial=None))


@query(
    f"""WITH s AS (SELECT *, CASE WHEN ts - pts <= INTERVAL 6 HOUR THEN p ELSE 0.0 END AS q FROM {LAGGED})
        SELECT event_id, id, temperature, round(abs(temperature - q), 6) AS diff FROM s
        WHERE abs(temperature - q) > 1.7"""
)
def temp_diff_ttl(spark, sf_dir):
    return _changes(stateful.value_change(_sensor(spark, sf_dir), "id", ORDER, "temperature", expire="6 hours"))


def _changes(rows):
    return rows.select("event_id", "id", "temperature", F.round("diff", 6).alias("diff"))


@query(
    f"""WITH s AS (SELECT *, sum(CASE WHEN temperature < p THEN 1 ELSE 0 END) OVER
                   (PARTITION BY id ORDER BY ts, event_id) AS seg FROM {LAGGED}),
             g AS (SELECT id, seg, min(ts) AS first_ts, min(ts) FILTER (temperature > p) AS t0 FROM s GROUP BY 1, 2),
             n AS (SELECT *, lead(first_ts) OVER (PARTITION BY id ORDER BY seg) AS nxt FROM g)
        SELECT id, t0 + INTERVAL 12 HOUR AS alert_at FROM n
        WHERE t0 IS NOT NULL AND (nxt IS NULL OR nxt > t0 + INTERVAL 12 HOUR)"""
)
def temp_rise_alert(spark, sf_dir):
    return stateful.rise_alerts(_sensor(spark, sf_dir), "id", ORDER, "temperature", "12 hours")


@query(
    f"""WITH RECURSIVE a AS (
          SELECT user_id, min(ts) AS anchor FROM events GROUP BY user_id
          UNION ALL
          SELECT e.user_id, min(e.ts) FROM a JOIN events e
          ON e.user_id = a.user_id AND e.ts > a.anchor + INTERVAL 12 HOUR GROUP BY e.user_id)
        SELECT a.user_id, a.anchor, a.anchor + INTERVAL 12 HOUR AS fired_at, count(*) AS count
        FROM a JOIN events e ON e.user_id = a.user_id AND e.ts BETWEEN a.anchor AND a.anchor + INTERVAL 12 HOUR
        GROUP BY 1, 2"""
)
def anchored_window_count(spark, sf_dir):
    return stateful.anchored_windows(_events(spark, sf_dir), ["user_id"], "ts", "12 hours")


@query(f"SELECT DISTINCT id, ts, ts + INTERVAL 9999 MILLISECOND AS fire_at FROM {SENSOR}")
def event_timer(spark, sf_dir):
    return stateful.event_timers(_sensor(spark, sf_dir), "id", "ts")


@query(f"SELECT event_id, id, ts, temperature, ts + INTERVAL 10 SECOND AS fire_at FROM {SENSOR}")
def forward_with_fire_at(spark, sf_dir):
    return stateful.forward_with_timer(_sensor(spark, sf_dir), "ts")


@query(
    """WITH s AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER
                  (PARTITION BY user_id ORDER BY ts, event_id) AS seg
                  FROM events WHERE event_type IN ('error', 'signup')),
            g AS (SELECT user_id, seg, min(ts) FILTER (event_type = 'error') AS f,
                         min(ts) FILTER (event_type = 'signup') AS began FROM s GROUP BY 1, 2),
            n AS (SELECT *, lead(began) OVER (PARTITION BY user_id ORDER BY seg) AS nxt FROM g)
       SELECT n.user_id, f + INTERVAL 12 HOUR AS alert_at FROM n
       WHERE (nxt IS NULL OR nxt > f + INTERVAL 12 HOUR)
       AND (SELECT count(*) FROM s WHERE s.user_id = n.user_id AND s.seg = n.seg AND event_type = 'error'
            AND s.ts <= f + INTERVAL 12 HOUR) >= 2"""
)
def login_fail_window(spark, sf_dir):
    return stateful.login_failures(
        _events(spark, sf_dir), "user_id", ORDER, "event_type", "12 hours", "error", "signup"
    )


@query(
    """WITH e AS (SELECT user_id, event_id, ts AS due, 0 AS r, event_type AS k FROM events
                  WHERE event_type IN ('click', 'purchase')),
            m AS (SELECT * FROM e UNION ALL SELECT user_id, event_id, due + INTERVAL 12 HOUR, 1, 'timer' FROM e),
            t AS (SELECT *, coalesce(sum(r) OVER (PARTITION BY user_id ORDER BY due, r, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS turn FROM m)
       SELECT user_id, min(due) FILTER (k = 'click') AS created_at, max(due) FILTER (k = 'timer') AS timeout_at
       FROM t GROUP BY user_id, turn
       HAVING count(*) FILTER (k = 'click') > 0 AND count(*) FILTER (k = 'purchase') = 0"""
)
def order_timeout_state(spark, sf_dir):
    return stateful.order_timeouts(
        _events(spark, sf_dir), "user_id", "ts", "event_type", "event_id", "12 hours", "click", "purchase"
    )


# --- patterns ------------------------------------------------------------------------------


@query(
    """WITH f AS (SELECT user_id, ts AS t1, lead(ts, 1) OVER w AS t2, lead(ts, 2) OVER w AS t3 FROM events
                  WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT * FROM f WHERE t3 IS NOT NULL"""
)
def cep_times3(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    found = match(events, Pattern.begin("fail", F.col("event_type") == "error").times(3), "user_id", ORDER)
    return found.select("user_id", *[F.col(f"fail_{i}.ts").alias(f"t{i}") for i in (1, 2, 3)])


@query(
    """WITH f AS (SELECT user_id, event_type AS k1, ts AS t1, lead(event_type, 1) OVER w AS k2, lead(ts, 1) OVER w AS t2,
                  lead(event_type, 2) OVER w AS k3, lead(ts, 2) OVER w AS t3 FROM events
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT user_id, t1, t2, t3 FROM f
       WHERE k1 = 'error' AND k2 = 'error' AND k3 = 'error' AND t3 - t1 < INTERVAL 12 HOUR"""
)
def cep_strict3_within(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    failed = F.col("event_type") == "error"
    pattern = Pattern.begin("one", failed).next("two", failed).next("three", failed).within("12 hours")
    found = match(events, pattern, "user_id", ORDER)
    return found.select("user_id", F.col("one.ts").alias("t1"), F.col("two.ts").alias("t2"), F.col("three.ts").alias("t3"))


@query(
    """WITH f AS (SELECT user_id, event_type AS k1, ts AS t1, lead(event_type) OVER w AS k2, lead(ts) OVER w AS t2
                  FROM events WHERE event_type IN ('click', 'purchase')
                  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
            o AS (SELECT *, CASE WHEN t2 IS NULL OR t2 - t1 >= INTERVAL 12 HOUR THEN 'timeout'
                                 WHEN k2 = 'purchase' THEN 'matched' END AS output FROM f WHERE k1 = 'click')
       SELECT user_id, t1 AS created_at, CASE WHEN output = 'matched' THEN t2 END AS paid_at, output
       FROM o WHERE output IS NOT NULL"""
)
def cep_order_timeout(spark, sf_dir):
    kind = F.col("event_type")
    events = _events(spark, sf_dir).filter(kind.isin("click", "purchase"))
    pattern = Pattern.begin("create", kind == "click").next("pay", kind == "purchase").within("12 hours")
    found = match(events.select("event_id", "ts", "user_id", "event_type"), pattern, "user_id", ORDER, timeouts=True)
    return found.select("user_id", F.col("create.ts").alias("created_at"), F.col("pay.ts").alias("paid_at"), "output")


# --- watermarks and late records -----------------------------------------------------------

ARRIVED = (
    f"(SELECT *, {end('ts', HOUR)} AS window_end, max(ts) OVER (ORDER BY arrival, event_id"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 6 HOUR AS wm"
    f" FROM {ARRIVALS})"
)
ARRIVAL = ["arrival", "event_id"]


@query(
    f"""SELECT event_id, id, max(ts) OVER (ORDER BY arrival, event_id) - INTERVAL 6 HOUR AS watermark
        FROM {ARRIVALS}"""
)
def watermark_trace(spark, sf_dir):
    rows = late.watermark_trace(_arrivals(spark, sf_dir), ARRIVAL, "ts", "6 hours")
    return rows.select("event_id", "id", "watermark")


@query(
    f"""SELECT event_id, id, window_end, CASE WHEN window_end <= wm THEN 'late' ELSE 'main' END AS output
        FROM {ARRIVED}"""
)
def late_window_side(spark, sf_dir):
    rows = late.late_for_window(_arrivals(spark, sf_dir), ARRIVAL, "ts", "1 hour", "6 hours")
    return rows.select("event_id", "id", "window_end", "output")


@query(f"SELECT event_id, id, CASE WHEN ts < wm THEN 'late' ELSE 'main' END AS output FROM {ARRIVED}")
def late_record_side(spark, sf_dir):
    rows = late.late_records(_arrivals(spark, sf_dir), ARRIVAL, "ts", "6 hours")
    return rows.select("event_id", "id", "output")


@query(
    f"""WITH c AS (SELECT *, wm IS NULL OR window_end > wm AS on_time FROM {ARRIVED}
                   WHERE wm IS NULL OR window_end > wm - INTERVAL 2 HOUR),
             n AS (SELECT *, count(*) OVER (PARTITION BY event_type, window_end ORDER BY arrival, event_id) AS n FROM c)
        SELECT event_type, window_end, NULL::bigint AS fired_by, false AS is_update, count(*) AS count
        FROM n WHERE on_time GROUP BY 1, 2
        UNION ALL
        SELECT event_type, window_end, event_id, n > 1, n FROM n WHERE NOT on_time"""
)
def late_update_window(spark, sf_dir):
    events = _events(spark, sf_dir)
    wait = ((F.col("event_id") * 37) % 20) * F.expr("INTERVAL 30 MINUTE")
    rows = events.select("event_id", "event_type", "ts", (F.col("ts") + wait).alias("arrival"))
    return late.updating_windows(rows, ["event_type"], ARRIVAL, "ts", "1 hour", "6 hours", "2 hours")


# --- SQL and tables ------------------------------------------------------------------------


@query(f"SELECT id, {end('ts', DAY)} AS window_end, count(*) AS count FROM {SENSOR} GROUP BY 1, 2")
def sql_tumble_count(spark, sf_dir):
    return windows.tumble_count_sql(spark, _view(_sensor(spark, sf_dir), "sensor"), "1 day")


@query(f"SELECT id, window_end, count(*) AS count FROM {hops(SENSOR, 6 * HOUR, HOUR)} GROUP BY 1, 2")
def sql_hop_count(spark, sf_dir):
    return windows.hop_count_sql(spark, _view(_sensor(spark, sf_dir), "sensor"), 360, 60)


@query(f"SELECT id, {start('ts', DAY)} AS window_start, count(id) AS count FROM {SENSOR} GROUP BY 1, 2")
def table_tumble_count(spark, sf_dir):
    readings = tables.table_from(_sensor(spark, sf_dir), id=F.col("id"), ts=F.col("ts"))
    return windows.tumbling(readings, ["id"], "ts", "1 day", F.count("id").alias("count")).drop("window_end")


@query(f"SELECT id, round(sum(temperature) / count(temperature), 6) AS avg_temp FROM {SENSOR} GROUP BY id")
def sql_udaf_avg(spark, sf_dir):
    user.register_average(spark)
    view = _view(_sensor(spark, sf_dir), "sensor")
    return spark.sql(
        f"SELECT id, round(mean, 6) AS avg_temp FROM"
        f" (SELECT id, avg_of(sum(temperature), count(temperature)) AS mean FROM {view} GROUP BY id)"
    )


LATERAL = """SELECT page_id, w.word, CAST(length(w.word) AS int) AS length FROM pages {join}
             (SELECT unnest(string_split_regex(regexp_replace(url, '[?#]+$', ''), '[?#]')) AS word) w{on}"""


@query(LATERAL.format(join="LEFT JOIN LATERAL", on=" ON true"))
def lateral_left(spark, sf_dir):
    user.register_split_words(spark, "split_words", "[?#]")
    pages = _view(model.table(spark, sf_dir, "pages"), "pages")
    return spark.sql(f"SELECT page_id, word, length FROM {pages} p LEFT JOIN LATERAL split_words(p.url) ON true")


@query(LATERAL.format(join=", LATERAL", on=""))
def lateral_cross(spark, sf_dir):
    user.register_split_words(spark, "split_words", "[?#]")
    pages = _view(model.table(spark, sf_dir, "pages"), "pages")
    return spark.sql(f"SELECT page_id, word, length FROM {pages} p, LATERAL split_words(p.url)")


# --- functions -----------------------------------------------------------------------------

# Units above U+FFFF are two UTF-16 units; the tables' texts are folded unit by unit.
UNITS = (
    "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 65536 THEN [unicode(c)::bigint]"
    " ELSE [55296 + ((unicode(c) - 65536)::bigint >> 10), 56320 + ((unicode(c) - 65536)::bigint & 1023)] END))"
)


@query(
    f"""WITH h AS (SELECT doc_id, list_reduce({UNITS.format(text='text')},
                          lambda a, c: (a * 31 + c) % 4294967296, 0::bigint) AS h FROM documents),
             t AS (SELECT doc_id, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) * 10) AS h FROM h)
        SELECT doc_id, CAST(((h + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS int) AS hash
        FROM t"""
)
def udf_hash_code(spark, sf_dir):
    spark.udf.register("hash_code_10", strings.hash_code_of_texts(factor=10))
    view = _view(model.table(spark, sf_dir, "documents"), "documents")
    return spark.sql(f"SELECT doc_id, hash_code_10(text) AS hash FROM {view}")


@query(
    f"""WITH h AS (SELECT user_id, list_reduce({UNITS.format(text="'sensor_' || user_id")},
                          lambda a, c: (a * 31 + c) % 4294967296, 0::bigint) AS h FROM events)
        SELECT user_id, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS int) AS hash FROM h"""
)
def udf_hash_code_short(spark, sf_dir):
    strings.register_hash_code(spark, "hash_code")
    view = _view(_events(spark, sf_dir), "events")
    return spark.sql(f"SELECT user_id, hash_code('sensor_' || user_id) AS hash FROM {view}")


@query(f"SELECT user_id, min(item_id) AS x, max(item_id) AS y FROM {BEHAVIOR} GROUP BY user_id")
def udaf_min_max(spark, sf_dir):
    return _behavior(spark, sf_dir).groupBy("user_id").agg(*user.min_max(F.col("item_id")))


@query(
    f"""SELECT id, temperature AS temp, rank FROM (SELECT id, temperature, row_number() OVER
        (PARTITION BY id ORDER BY temperature DESC) AS rank FROM {SENSOR}) WHERE rank <= 2"""
)
def top2_per_key(spark, sf_dir):
    return user.top_two(_sensor(spark, sf_dir), "id", "temperature")


@query(
    f"""WITH s AS (SELECT id, min(temperature) AS lo, max(temperature) AS hi,
                         arg_min(event_id, (temperature, event_id)) AS lo_id, arg_max(event_id, (temperature, -event_id)) AS hi_id
                  FROM {SENSOR} GROUP BY id)
        SELECT id, 'coldest' AS what, lo_id AS event_id, lo AS temperature FROM s
        UNION ALL SELECT id, 'warmest', hi_id, hi FROM s WHERE hi > lo"""
)
def flat_aggregate_extremes(spark, sf_dir):
    """The coldest and the warmest reading of a sensor, one row each; one row if they are alike."""
    at = F.struct("temperature", "event_id")
    first = F.struct("temperature", -F.col("event_id"))

    def extremes(s):
        def row(what, event, value):
            return F.struct(F.lit(what).alias("what"), event.alias("event_id"), value.alias("temperature"))

        warmest = row("warmest", s["hi"]["event_id"], s["hi"]["temperature"])
        differ = s["hi"]["temperature"] > s["lo"]["temperature"]
        return F.array(row("coldest", s["lo"]["event_id"], s["lo"]["temperature"]), F.when(differ, warmest))

    state = {"lo": F.min(at), "hi": F.max_by(at, first)}
    return user.flat_aggregate(_sensor(spark, sf_dir), ["id"], state, extremes)


@query(
    """SELECT doc_id, len(p) AS words, p[1] AS head, p[-1] AS tail FROM
       (SELECT doc_id, string_split_regex(regexp_replace(text, '\\s+$', ''), '\\s') AS p FROM documents)"""
)
def fn_split(spark, sf_dir):
    part = strings.java_split(F.col("text"), r"\s")
    docs = model.table(spark, sf_dir, "documents").select("doc_id", part.alias("p"))
    return docs.select(
        "doc_id",
        F.size("p").cast("bigint").alias("words"),
        F.element_at("p", 1).alias("head"),
        F.element_at("p", -1).alias("tail"),
    )


@query(
    """SELECT o_orderkey, TRY_CAST(string_split(o_orderpriority, '-')[1] AS int) AS rank,
              TRY_CAST(string_split(o_orderpriority, '-')[2] AS bigint) AS bad FROM orders"""
)
def fn_parse_numbers(spark, sf_dir):
    part = F.split("o_orderpriority", "-")
    return model.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.get(part, 0).try_cast("int").alias("rank"), F.get(part, 1).try_cast("bigint").alias("bad")
    )


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, least(l_discount, l_tax) AS low, greatest(l_discount, l_tax) AS high
       FROM lineitem"""
)
def fn_least_greatest(spark, sf_dir):
    return model.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.least("l_discount", "l_tax").alias("low"),
        F.greatest("l_discount", "l_tax").alias("high"),
    )


@query(f"SELECT event_id, 'sensor ' || id || ' reads ' || temperature AS message FROM {SENSOR}")
def fn_message(spark, sf_dir):
    readings = _sensor(spark, sf_dir)
    return readings.select(
        "event_id", F.concat(F.lit("sensor "), F.col("id"), F.lit(" reads "), F.col("temperature")).alias("message")
    )


# --- rankings and visitors -----------------------------------------------------------------


def ranked_sql(source: str, item: str, size: int, slide: int, n: int, count: str = "count") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY {count} DESC, {item})
               AS row_num FROM (SELECT window_end, {item}, count(*) AS {count} FROM {hops(source, size, slide)}
               GROUP BY 1, 2)) WHERE row_num <= {n}"""


VIEWS = f"(SELECT * FROM {BEHAVIOR} WHERE behavior = 'view')"


@query(ranked_sql(VIEWS, "item_id", HOUR, 5 * MINUTE, 3))
def top_items(spark, sf_dir):
    return rank.top_items(_behavior(spark, sf_dir), view="view")


LOG = f"(SELECT date_trunc('second', ts) AS ts, '/item/' || item_id AS url FROM {BEHAVIOR})"


@query(ranked_sql(LOG, "url", 10 * MINUTE, 5_000_000, 5))
def top_urls(spark, sf_dir):
    log = _ntz(lines.good(lines.parse_weblog(model.weblog_lines(_events(spark, sf_dir)))), "ts")
    return rank.top_urls(log)


@query(ranked_sql(VIEWS, "item_id", HOUR, 5 * MINUTE, 3, "icount"))
def sql_top_items(spark, sf_dir):
    return rank.sql_top_items(spark, _view(_behavior(spark, sf_dir), "behavior"), "view")


@query(
    f"""SELECT window_end, repeat('=', 39) || chr(10) || 'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10)
        || string_agg('No.' || row_num || ': item_id = ' || item_id || ' count = ' || count, chr(10) ORDER BY row_num)
        || chr(10) || repeat('=', 39) AS report
        FROM ({ranked_sql(VIEWS, 'item_id', HOUR, 5 * MINUTE, 3)}) GROUP BY window_end"""
)
def top_items_report(spark, sf_dir):
    return rank.report(rank.top_items(_behavior(spark, sf_dir), view="view"), "item_id")


@query(f"SELECT {end('ts', HOUR)} AS window_end, count(DISTINCT user_id) AS uv FROM {VIEWS} GROUP BY 1")
def uv_exact(spark, sf_dir):
    return visitors.exact(_behavior(spark, sf_dir), view="view").drop("window_start")


@query(
    f"""SELECT {end('ts', HOUR)} AS window_end, count(DISTINCT list_reduce(
        {UNITS.format(text='CAST(user_id AS varchar)')}, lambda a, c: (a * 61 + c) % 256, 0::bigint)) AS uv
        FROM {VIEWS} GROUP BY 1"""
)
def uv_bitmap(spark, sf_dir):
    return visitors.by_bits(_behavior(spark, sf_dir), view="view").drop("window_start")


@query(f"SELECT {end('ts', HOUR)} AS window_end, true AS within_error FROM {VIEWS} GROUP BY 1")
def uv_approx(spark, sf_dir):
    """Whether the sketch is within three times its stated error of the exact count."""
    error = 0.01
    near = visitors.approximate(_behavior(spark, sf_dir), view="view", error=error).select("window_end", F.col("uv").alias("near"))
    both = visitors.exact(_behavior(spark, sf_dir), view="view").join(near, "window_end", "left")
    off = F.abs(F.col("near") - F.col("uv")) <= F.greatest(F.lit(1.0), 3 * error * F.col("uv"))
    return both.select("window_end", F.coalesce(off, F.lit(False)).alias("within_error"))


# --- streams -------------------------------------------------------------------------------
#
# Each runs over what the source holds now, to its end, so the SQL is that of the whole table.

DELAY = "1 hour"


def _stream(spark, sf_dir, name="events", ts="ts", where="true"):
    """A table as a bounded stream of the rows that ``where`` keeps."""
    rows = model.table_stream(spark, sf_dir, name).filter(where)
    return operators.with_event_time(operators.with_end(rows, ts), ts, DELAY)


def _times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in columns})


@query(
    f"""SELECT user_id, {end('ts', DAY)} AS window_end, count(*) AS count FROM events GROUP BY 1, 2"""
)
def tumble_count_wm(spark, sf_dir):
    counts = operators.tumble_count(_stream(spark, sf_dir), ["user_id"], "ts", "1 day")
    return _ntz(operators.finished(spark, counts, "tumble-count"), "window_end").drop("window_start")


@query(ORACLES["uv_exact"])
def stream_uv_exact(spark, sf_dir):
    views = _stream(spark, sf_dir, where="event_type = 'view'")
    counts = operators.unique_visitors(views, "user_id", "ts", "1 hour")
    return _ntz(operators.finished(spark, counts, "uv"), "window_end").drop("window_start")


@query(ORACLES["top_items"])
def stream_top_items(spark, sf_dir):
    views = model.user_behavior(_stream(spark, sf_dir, where="event_type = 'view'"))
    path = shared_dir(spark, "top-items")
    operators.rank_batches(
        views, "item_id", "ts", "1 hour", "5 minutes", 3,
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"),
        shared_dir(spark, "top-items-checkpoint"), together="1 hour",
    ).awaitTermination()
    return _ntz(spark.read.parquet(path).drop("batch"), "window_end")


@query(ORACLES["interval_join"])
def stream_interval_join(spark, sf_dir):
    orders = _stream(spark, sf_dir, "orders", "o_orderdate")
    items = _stream(spark, sf_dir, "lineitem", "l_shipdate")
    pairs = operators.interval_join(
        orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderdate"),
        items.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate"),
        "orderkey", "o_orderdate", "l_shipdate", "-30 days", "30 days",
    )
    return _ntz(operators.finished(spark, pairs, "interval-join"), "o_orderdate", "l_shipdate")


def _folded(spark, sf_dir, fold, label, **columns):
    found = processors.run_fold(_stream(spark, sf_dir), fold, "user_id", "ts", "event_id", **columns)
    return operators.finished(spark, found, label)


@query(
    f"""SELECT user_id, d.event_id, d.temperature AS value, d.diff FROM ({ORACLES['temp_diff_ttl']}) d
        JOIN events e ON d.event_id = e.event_id"""
)
def stream_temp_diff_ttl(spark, sf_dir):
    fold = folds.ValueChange(expire=6 * HOUR)
    found = _folded(spark, sf_dir, fold, "temp-diff", value=F.col("value"))
    return found.select("user_id", F.col("tie").alias("event_id"), "value", F.round("diff", 6).alias("diff"))


@query(f"SELECT CAST(id AS bigint) AS user_id, alert_at FROM ({ORACLES['temp_rise_alert']})")
def stream_temp_rise_alert(spark, sf_dir):
    found = _folded(spark, sf_dir, folds.RiseAlert(12 * HOUR), "rise", value=F.col("value"))
    return _times(found, "alert_at")


@query(ORACLES["anchored_window_count"])
def stream_anchored_window_count(spark, sf_dir):
    return _times(_folded(spark, sf_dir, folds.AnchoredCount(12 * HOUR), "anchored"), "anchor", "fired_at")


@query(ORACLES["login_fail_window"])
def stream_login_fail_window(spark, sf_dir):
    fold = folds.LoginFailures(12 * HOUR, "error", "signup")
    return _times(_folded(spark, sf_dir, fold, "login", kind=F.col("event_type")), "alert_at")


@query(ORACLES["order_timeout_state"])
def stream_order_timeout(spark, sf_dir):
    fold = folds.OrderTimeouts(12 * HOUR, "click", "purchase")
    found = _folded(spark, sf_dir, fold, "order-timeout", kind=F.col("event_type"))
    return _times(found, "created_at", "timeout_at")


@query(ORACLES["retract_changelog"])
def stream_retract_changelog(spark, sf_dir):
    item = F.get_json_object("props", "$.k")
    found = _folded(spark, sf_dir, folds.MinMaxChanges(), "changelog", value=item.cast("bigint"))
    return _times(found.withColumnRenamed("at", "ts").withColumnRenamed("tie", "event_id"), "ts")


@query(
    f"""SELECT event_id, user_id, value FROM ({ORACLES['switch_filter']})"""
)
def stream_switch_filter(spark, sf_dir):
    on = F.col("event_type") == "signup"
    length = (F.get_json_object("props", "$.k").cast("bigint") + 1) * 60_000_000
    # A switch sorts before a reading of the same time.
    rows = _stream(spark, sf_dir).withColumn("order", F.when(on, -1).otherwise(F.col("event_id")))
    found = processors.run_fold(
        rows, folds.SwitchFilter(), "user_id", "ts", "order",
        value=F.when(on, length).otherwise(F.col("value")), kind=F.when(on, "switch"),
    )
    out = operators.finished(spark, found, "switch")
    return out.select(F.col("tie").alias("event_id"), "user_id", "value")


@query(
    f"""SELECT user_id, ts AS at, ts + INTERVAL 9999 MILLISECOND AS fire_at FROM events
        GROUP BY user_id, ts"""
)
def stream_event_timer(spark, sf_dir):
    return _times(_folded(spark, sf_dir, folds.EventTimers(9_999_000), "timers"), "at", "fire_at")


def _matched(spark, sf_dir, pattern, label, where="true", timeouts=False):
    rows = _stream(spark, sf_dir, where=where).select("event_id", "ts", "user_id", "event_type")
    found = stream_patterns.match(rows, pattern, "user_id", "ts", "event_id", timeouts)
    return operators.finished(spark, found, label)


@query(ORACLES["cep_order_timeout"])
def stream_cep_order_timeout(spark, sf_dir):
    kind = F.col("event_type")
    pattern = Pattern.begin("create", kind == "click").next("pay", kind == "purchase").within("12 hours")
    found = _matched(spark, sf_dir, pattern, "cep", "event_type IN ('click', 'purchase')", timeouts=True)
    out = found.select("user_id", F.col("create.ts").alias("created_at"), F.col("pay.ts").alias("paid_at"), "output")
    return _ntz(out, "created_at", "paid_at")


@query(ORACLES["cep_times3"])
def stream_cep_times3(spark, sf_dir):
    pattern = Pattern.begin("fail", F.col("event_type") == "error").times(3)
    found = _matched(spark, sf_dir, pattern, "cep-times")
    return _ntz(found.select("user_id", *[F.col(f"fail_{i}.ts").alias(f"t{i}") for i in (1, 2, 3)]), "t1", "t2", "t3")


@query(ORACLES["cep_strict3_within"])
def stream_cep_strict3_within(spark, sf_dir):
    failed = F.col("event_type") == "error"
    pattern = Pattern.begin("one", failed).next("two", failed).next("three", failed).within("12 hours")
    found = _matched(spark, sf_dir, pattern, "cep-strict")
    steps = [F.col(f"{name}.ts").alias(f"t{i + 1}") for i, name in enumerate(("one", "two", "three"))]
    return _ntz(found.select("user_id", *steps), "t1", "t2", "t3")


@query(f"SELECT CAST(id AS bigint) AS user_id, window_end, fired_at, count FROM ({ORACLES['window_early_fire']})")
def stream_early_fire(spark, sf_dir):
    fold = folds.EarlyCounts(24 * HOUR, 4 * HOUR)
    return _times(_folded(spark, sf_dir, fold, "early-fire"), "window_end", "fired_at")


@query(
    """WITH p AS (SELECT l_orderkey AS k, l_shipdate AS pay_at FROM lineitem WHERE l_linenumber = 1),
            m AS (SELECT o_orderkey, o_orderdate, pay_at FROM orders JOIN p ON k = o_orderkey
                  AND pay_at BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY)
       SELECT o_orderkey AS orderkey, o_orderdate AS order_at, pay_at, 'matched' AS output FROM m
       UNION ALL SELECT o_orderkey, o_orderdate, NULL, 'unmatched_order' FROM orders
       WHERE o_orderkey NOT IN (SELECT o_orderkey FROM m)
       UNION ALL SELECT k, NULL, pay_at, 'unmatched_pay' FROM p
       WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = p.k AND m.pay_at = p.pay_at)"""
)
def stream_reconcile(spark, sf_dir):
    orders = _stream(spark, sf_dir, "orders", "o_orderdate")
    pays = _stream(spark, sf_dir, "lineitem", "l_shipdate", where="l_linenumber = 1")
    found = operators.reconcile(
        orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderdate"),
        pays.select(F.col("l_orderkey").alias("orderkey"), "l_shipdate"),
        "orderkey", "o_orderdate", "l_shipdate", "30 days",
    )
    done = operators.finished(spark, found, "reconcile").filter("orderkey IS NOT NULL")  # without the end markers
    return _ntz(done, "order_at", "pay_at")


@query(ORACLES["top_urls"])
def stream_top_urls(spark, sf_dir):
    log = lines.good(lines.parse_weblog(model.weblog_lines(model.table_stream(spark, sf_dir, "events"))))
    log = operators.with_event_time(operators.with_end(log, "ts"), "ts", DELAY)
    path = shared_dir(spark, "top-urls")
    operators.rank_batches(
        log, "url", "ts", "10 minutes", "5 seconds", 5,
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}"),
        shared_dir(spark, "top-urls-checkpoint"), together="10 minutes",
    ).awaitTermination()
    return _ntz(spark.read.parquet(path).drop("batch"), "window_end")


# Records that come late need batches in order of arrival: four, of equal spans of arrival time.

PARTS = 4
PART_ARRIVED = f"""(
    SELECT p.*, wm FROM
        (SELECT *, {end('ts', HOUR)} AS window_end, least({PARTS - 1}, {PARTS} * (epoch_us(arrival) - lo) // greatest(1, hi - lo)) AS part
         FROM {ARRIVALS}, (SELECT min(epoch_us(arrival)) AS lo, max(epoch_us(arrival)) AS hi FROM {ARRIVALS})) p
    JOIN (SELECT part, max(max(date_trunc('millisecond', ts))) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL 6 HOUR AS wm
          FROM (SELECT ts, least({PARTS - 1}, {PARTS} * (epoch_us(arrival) - lo) // greatest(1, hi - lo)) AS part
                FROM {ARRIVALS}, (SELECT min(epoch_us(arrival)) AS lo, max(epoch_us(arrival)) AS hi FROM {ARRIVALS}))
          GROUP BY part) w ON w.part = p.part)"""


def _in_parts(spark, sf_dir, run, last=True):
    """Write the events part by part, in order of arrival, and ``run`` the stream of the folder after each."""
    rows = _events(spark, sf_dir)
    at = F.unix_micros((F.col("ts") + ((F.col("event_id") * 37) % 20) * F.expr("INTERVAL 30 MINUTE")).cast("timestamp"))
    rows = rows.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), at.alias("at"))
    bounds = rows.agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    step = F.expr(f"least({PARTS - 1}, {PARTS} * (at - lo) div greatest(1, hi - lo))")
    rows = rows.join(F.broadcast(bounds)).withColumn("part", step).drop("at", "lo", "hi")  # one row
    folder = shared_dir(spark, "arriving")
    for part in range(PARTS):
        some = rows.filter(F.col("part") == part)
        if last and part == PARTS - 1:
            ends = [F.lit(operators.END if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in rows.schema]
            some = some.unionByName(spark.range(1).select(*ends))
        some.write.mode("append").parquet(folder)
        run(spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


@query(
    f"""WITH c AS (SELECT *, wm IS NULL OR window_end > wm AS on_time FROM {PART_ARRIVED}
                   WHERE wm IS NULL OR window_end > wm - INTERVAL 2 HOUR),
             n AS (SELECT *, count(*) OVER (PARTITION BY event_type, window_end ORDER BY part, event_id) AS n FROM c)
        SELECT event_type, window_end, NULL::bigint AS fired_by, false AS is_update, count(*) AS count
        FROM n WHERE on_time GROUP BY 1, 2
        UNION ALL
        SELECT event_type, window_end, event_id, n > 1, n FROM n WHERE NOT on_time"""
)
def stream_late_update(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "late-update"), shared_dir(spark, "late-update-checkpoint")
    schema = None

    def run(stream):
        nonlocal schema
        found = stream_windows.late_updates(stream, ["event_type"], "ts", "event_id", "1 hour", "6 hours", "2 hours")
        schema = found.schema
        return to_table(found, out, checkpoint)

    _in_parts(spark, sf_dir, run)
    return _ntz(spark.read.schema(schema).parquet(out), "window_end")


@query(
    f"""SELECT event_id, event_type, CASE WHEN wm IS NOT NULL AND window_end <= wm THEN 'late' ELSE 'main' END AS output
        FROM {PART_ARRIVED}"""
)
def stream_late_side(spark, sf_dir):
    folder, tops = shared_dir(spark, "late-side"), shared_dir(spark, "late-side-tops")
    checkpoint = shared_dir(spark, "late-side-checkpoint")
    sinks = {k: (lambda df, k=k: df.write.mode("append").parquet(f"{folder}/output={k}")) for k in ("main", "late")}
    _in_parts(spark, sf_dir, lambda s: operators.route_late(s, "ts", "6 hours", sinks, tops, checkpoint, "1 hour"), last=False)
    return spark.read.parquet(folder).select("event_id", "event_type", "output")
