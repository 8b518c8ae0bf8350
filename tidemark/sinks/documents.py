"""Documents for a search index, in bulks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import HotKeys, Ordered, running_count


def index_documents(
    df: DataFrame,
    index: str,
    fields: Sequence[str],
    order: Sequence[str],
    bulk: int = 10,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One JSON document per row, and the bulk it is sent in; bulks hold ``bulk`` rows in order.

    The rows are numbered piece by piece, so no task sees them all.
    """
    numbered = Ordered(df, [], order, hot).running(_n=running_count()).rows()
    return numbered.select(
        *order,
        F.lit(index).alias("index"),
        F.floor((F.col("_n") - 1) / bulk).cast("bigint").alias("bulk"),
        F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in fields])).alias("document"),
    )


def text_documents(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The one-field form: the whole record as text under ``data``."""
    record = F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))
    return df.select(F.to_json(F.struct(record.alias("data"))).alias("document"))


def bulk_options(nodes: str, bulk: int = 10) -> dict[str, str]:
    """Options of the search connector's Spark writer."""
    return {"es.nodes": nodes, "es.batch.size.entries": str(bulk), "es.input.json": "true"}
