"""User-defined functions: the table function, the average, min/max and table aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.strings import utf16_length, without_trailing_empty
from tidemark.operators.rank import top_n

# Fixed value: what the second place of a top-2 shows while a key has only one value.
NO_SECOND = -2147483648.0


def split_words(df: DataFrame, text: str, pattern: str, keep_empty: bool) -> DataFrame:
    """Table function: each text to (word, length) rows, beside the other columns.

    ``keep_empty`` keeps a row with NULLs when a text gives no words, as a left lateral join.
    """
    parts = df.withColumn("_parts", F.split(text, pattern))
    explode = F.explode_outer if keep_empty else F.explode
    words = parts.withColumn("word", explode(without_trailing_empty(F.col("_parts")))).drop("_parts")
    return words.withColumn("length", utf16_length(F.col("word")))


def register_split_words(spark: SparkSession, name: str = "split_words", pattern: str = "#") -> None:
    """The same table function for SQL, as ``FROM t, LATERAL split_words(t.s)``: a function Catalyst inlines.

    Trailing empty strings go, as in :func:`java_split`; a text of separators only gives no rows.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    kept = f"regexp_replace(s, '(?:{quoted})+$', '')"
    words = f"CASE WHEN s = '' THEN array('') WHEN {kept} = '' THEN CAST(array() AS array<string>) ELSE split({kept}, '{quoted}') END"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS TABLE(word STRING, length INT) "
        "RETURN SELECT word, CAST(octet_length(encode(word, 'UTF-16BE')) / 2 AS INT) "
        f"FROM (SELECT explode({words}) AS word)"
    )


def register_average(spark: SparkSession, name: str = "avg_of") -> None:
    """The result step of the (sum, count) average, for SQL.

    Its accumulator is the built-in ``sum`` and ``count``, so ``avg_of(sum(x), count(x))`` still
    aggregates in part on the map side; a Python aggregate would hold each whole group in memory.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(total DOUBLE, n BIGINT) RETURNS DOUBLE RETURN total / n"
    )


def min_max(value: Column) -> tuple[Column, Column]:
    """The aggregate that returns a row (x, y): smallest and largest value as bigint."""
    return F.min(value).cast("bigint").alias("x"), F.max(value).cast("bigint").alias("y")


def top_two(df: DataFrame, key: str, value: str, pad: bool = False) -> DataFrame:
    """Table aggregate: the two largest values per key with their rank, duplicates kept.

    Each map task keeps two rows per key before the shuffle. ``pad`` shows the placeholder second
    place of keys with one value.
    """
    best = top_n(df.select(key, F.col(value).alias("temp")), [key], [F.col("temp").desc()], 2, "rank")
    if not pad:
        return best
    places = F.sort_array(F.collect_list(F.struct("rank", "temp")))
    second = F.struct(F.lit(2).cast("bigint").alias("rank"), F.lit(NO_SECOND).alias("temp"))
    return (
        best.groupBy(key)
        .agg(places.alias("_p"))
        .withColumn("_p", F.when(F.size("_p") < 2, F.concat("_p", F.array(second))).otherwise(F.col("_p")))
        .select(key, F.explode("_p").alias("_p"))
        .select(key, "_p.temp", "_p.rank")
    )


def flat_aggregate(
    df: DataFrame, keys: list[str], accumulate: Mapping[str, Column], emit: Callable[[Column], Column]
) -> DataFrame:
    """Table aggregate of any kind: the keys and the fields of each row that a group's accumulator gives.

    ``accumulate`` names aggregate expressions, which Spark computes in part before the shuffle; ``emit`` gets
    them as one struct and returns an array of structs with named fields. A group whose array is NULL or empty
    gives no rows, and NULL elements are left out. Without ``keys`` all rows are one group, also of an empty table.
    """
    state, row = unused(df.columns, "_state"), unused([*keys], "_row")
    fields = F.struct(*[c.alias(name) for name, c in accumulate.items()])
    groups = df.groupBy(*keys).agg(fields.alias(state))
    rows = groups.select(*keys, F.explode(F.array_compact(emit(F.col(state)))).alias(row))
    return rows.select(*keys, f"{row}.*")


def unused(names: list[str], wish: str) -> str:
    """``wish``, with underscores before it until no column is named so."""
    while wish.lower() in {n.lower() for n in names}:
        wish = f"_{wish}"
    return wish
