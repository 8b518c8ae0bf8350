"""Tables and views over files and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def csv_table(spark: SparkSession, view: str, columns: str, path: str) -> DataFrame:
    """``CREATE VIEW .. USING csv`` with a schema in SQL, and a processing-time column ``pt``."""
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view}_file ({columns}) USING csv OPTIONS (path '{quoted}')"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT *, current_timestamp() AS pt FROM {view}_file"
    )
    return spark.table(view)


def table_from(df: DataFrame, rowtime: str | None = None, delay: str = "0 seconds", **columns: Column) -> DataFrame:
    """Chosen and renamed columns, with an event-time column for a stream's windows."""
    table = df.select(*[c.alias(n) for n, c in columns.items()]) if columns else df
    return table.withWatermark(rowtime, delay) if rowtime and table.isStreaming else table


def as_view(df: DataFrame, name: str) -> str:
    """Register a frame, batch or streaming, as a temporary view and give its name back."""
    df.createOrReplaceTempView(name)
    return name
