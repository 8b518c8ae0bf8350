"""Line parsers and file sources. The parsers take any batch or streaming frame of lines.

A line that does not parse, or lacks its key or time, is kept aside: each parser returns rows with
an ``error`` column that holds the line, NULL for good rows; ``good`` and ``bad`` split them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Positions of the web log's fields in a split on one space, and its date pattern,
# which takes days, months and hours of one or two digits.
LOG_IP, LOG_USER, LOG_TIME, LOG_METHOD, LOG_URL = 0, 2, 3, 5, 6
LOG_DATE = "d/M/yyyy:H:mm:ss"


def good(parsed: DataFrame) -> DataFrame:
    """The rows that parsed."""
    return parsed.filter(F.col("error").isNull()).drop("error")


def bad(parsed: DataFrame) -> DataFrame:
    """The lines that did not."""
    return parsed.filter(F.col("error").isNotNull()).select("error")


def _checked(lines: DataFrame, line: str, **fields: Column) -> DataFrame:
    parsed = lines.select(F.col(line).alias("error"), *[c.alias(n) for n, c in fields.items()])
    whole = F.lit(True)
    for name in fields:
        whole = whole & F.col(name).isNotNull()
    return parsed.select(*fields, F.when(whole, None).otherwise(F.col("error")).alias("error"))


def parse_behavior(lines: DataFrame, line: str = "value") -> DataFrame:
    """``user,item,category,behavior,seconds`` lines."""
    part = F.split(line, ",")
    return _checked(
        lines,
        line,
        user_id=F.get(part, 0).try_cast("bigint"),
        item_id=F.get(part, 1).try_cast("bigint"),
        category_id=F.get(part, 2).try_cast("int"),
        behavior=F.get(part, 3),
        ts=F.timestamp_seconds(F.get(part, 4).try_cast("bigint")),
    )


def parse_weblog(lines: DataFrame, line: str = "value") -> DataFrame:
    """Web-log lines of fields separated by one space."""
    part = F.split(line, " ")
    return _checked(
        lines,
        line,
        ip=F.get(part, LOG_IP),
        user_id=F.get(part, LOG_USER),
        ts=F.try_to_timestamp(F.get(part, LOG_TIME), F.lit(LOG_DATE)),
        method=F.get(part, LOG_METHOD),
        url=F.get(part, LOG_URL),
    )


def parse_keyed(lines: DataFrame, line: str = "value") -> DataFrame:
    """``key seconds`` lines."""
    part = F.split(line, " ")
    return _checked(
        lines, line, key=F.get(part, 0), ts=F.timestamp_seconds(F.get(part, 1).try_cast("bigint"))
    )


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text lines of a file or folder; a stream reads files as they appear."""
    return (spark.readStream if stream else spark.read).text(path)


def read_behavior(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Behaviour records of a comma-separated file."""
    return parse_behavior(read_lines(spark, path, stream))


def read_weblog(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Web-log records of a file."""
    return parse_weblog(read_lines(spark, path, stream))


def read_keyed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Keyed lines of a file."""
    return parse_keyed(read_lines(spark, path, stream))
