"""Keyed sinks: the latest row per key, as relational upserts or hash fields."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the hash that holds one field per sensor.
SENSOR_HASH = "sensor_temperature"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; one partial maximum per key and map task."""
    others = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


def hash_rows(df: DataFrame, key: str, value: str, order: Sequence[str], name: str = SENSOR_HASH) -> DataFrame:
    """(hash, field, value) rows, one per key with its last value."""
    last = latest_per_key(df, [key], order)
    return last.select(
        F.lit(name).alias("hash"), F.col(key).cast("string").alias("field"), F.col(value).cast("string").alias("value")
    )


def write_hash(rows: DataFrame, put: Callable[[Iterator[Row]], None]) -> None:
    """Hand each partition's rows to ``put``, which opens one connection and sends them in bulk."""
    rows.foreachPartition(put)


def merge_statement(
    target: str, staged: str, keys: Sequence[str], values: Sequence[str], quote: str = '"'
) -> str:
    """One MERGE: update the rows whose key is there, insert the others.

    The staged table's columns are quoted, as Spark's JDBC writer creates them.
    """
    names = [*keys, *values]
    of = {n: f"s.{quote}{n}{quote}" for n in names}
    on = " AND ".join(f"t.{k} = {of[k]}" for k in keys)
    sets = ", ".join(f"t.{v} = {of[v]}" for v in values)
    return (
        f"MERGE INTO {target} t USING {staged} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join(of.values())})"
    )


def upsert(
    df: DataFrame,
    url: str,
    driver: str,
    target: str,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
    options: dict[str, str] | None = None,
) -> None:
    """Upsert the latest row per key: executors stage the rows over JDBC, then one MERGE runs.

    Only the MERGE goes through the driver; a batch that is tried again gives the same table. Each
    call stages in a table of its own, with the target's text types, and drops it.
    """
    spark: SparkSession = df.sparkSession
    staged = f"{target}_{uuid.uuid4().hex[:12]}"
    last = latest_per_key(df, keys, order).select(*keys, *values)
    texts = [f.name for f in last.schema.fields if isinstance(f.dataType, StringType)]
    properties = spark._jvm.java.util.Properties()
    for k, v in (options or {}).items():
        properties.setProperty(k, v)
    spark._jvm.java.lang.Class.forName(driver)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        statement = connection.createStatement()
        types = _text_types(statement, target, texts)
        writer = last.write.format("jdbc").options(url=url, driver=driver, dbtable=staged, **(options or {}))
        if types:
            writer = writer.option("createTableColumnTypes", ", ".join(f"{t} {kind}" for t, kind in types.items()))
        writer.mode("overwrite").save()
        try:
            statement.executeUpdate(merge_statement(target, staged, keys, values))
        finally:
            statement.executeUpdate(f"DROP TABLE {staged}")
            statement.close()
    finally:
        connection.close()


def _text_types(statement, target: str, names: Sequence[str]) -> dict[str, str]:
    """The types that the target table gives its text columns, lengths included."""
    if not names:
        return {}
    found = statement.executeQuery(f"SELECT {', '.join(names)} FROM {target} WHERE 1 = 0")
    about = found.getMetaData()
    types = {}
    for i, name in enumerate(names, 1):
        kind, size = about.getColumnTypeName(i), about.getPrecision(i)
        types[name] = f"{kind}({size})" if kind.upper().endswith(("CHAR", "VARCHAR2")) and size else kind
    found.close()
    return types


def upsert_each_batch(**settings) -> Callable[[DataFrame, int], None]:
    """The same for a stream's ``foreachBatch``."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, **settings)

    return write
