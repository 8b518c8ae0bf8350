"""Record schemas (as DDL), and the event records as the given tables hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import use_utc

SENSOR_READING = "id string, ts timestamp, temperature double"
USER_BEHAVIOR = "user_id bigint, item_id bigint, category_id int, behavior string, ts timestamp"
WEB_LOG = "ip string, user_id string, ts timestamp, method string, url string"
MARKETING = "user_id string, behavior string, channel string, ts timestamp"
LOGIN_EVENT = "user_id string, ip string, event_type string, ts timestamp"
ORDER_EVENT = "order_id string, event_type string, ts timestamp"
PAY_EVENT = ORDER_EVENT
KEYED_LINE = "key string, ts timestamp"
SWITCH = "id string, duration_ms bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table, one file or a folder of part files, as a stream; its schema is the table's own."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _item_id():
    return F.get_json_object("props", "$.k").cast("bigint")


def sensor_readings(events: DataFrame) -> DataFrame:
    """Events as sensor readings, the user as the sensor."""
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("id"), "ts", F.col("value").alias("temperature")
    )


def user_behavior(events: DataFrame) -> DataFrame:
    """Events as shop behaviour, under the event's own name: a view is ``view``."""
    return events.select(
        "event_id",
        "user_id",
        _item_id().alias("item_id"),
        (_item_id() % 10).cast("int").alias("category_id"),
        F.col("event_type").alias("behavior"),
        "ts",
    )


def marketing(events: DataFrame) -> DataFrame:
    """Events as app marketing behaviour over two channels; ``error`` stands for an uninstall."""
    return events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("behavior"),
        F.when(_item_id() % 2 == 0, "north").otherwise("south").alias("channel"),
        "ts",
    )


def switches(events: DataFrame) -> DataFrame:
    """Sign-ups as switches that stay on for a number of minutes taken from the item."""
    return events.filter(F.col("event_type") == "signup").select(
        "user_id", "ts", ((_item_id() + 1) * 60_000_000).alias("duration")
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Readings with an arrival time that is up to ten hours out of step with their event time."""
    wait = ((F.col("event_id") * 37) % 20) * F.expr("INTERVAL 30 MINUTE")
    return sensor_readings(events).withColumn("arrival", F.col("ts") + wait)


def weblog_lines(events: DataFrame) -> DataFrame:
    """Events as space-separated web-log lines."""
    return events.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("10.0.0."), F.col("user_id") % 256),
            F.lit("-"),
            F.col("user_id"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"),
            F.concat(F.lit("/item/"), _item_id()),
        ).alias("value")
    )


def behavior_lines(events: DataFrame) -> DataFrame:
    """Events as comma-separated behaviour lines with the time in seconds."""
    b = user_behavior(events)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return b.select(F.concat_ws(",", "user_id", "item_id", "category_id", "behavior", seconds).alias("value"))


def keyed_lines(events: DataFrame) -> DataFrame:
    """Events as ``key seconds`` lines."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return events.select(F.concat_ws(" ", "user_id", seconds).alias("value"))
