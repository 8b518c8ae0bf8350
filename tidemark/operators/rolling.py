"""Keyed aggregations that give one output per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordered import (
    HotKeys,
    Ordered,
    first_row,
    running_count,
    running_max,
    running_min,
    running_sum,
)


def _rolling(df, keys, order, field, spec, kept, hot) -> DataFrame:
    firsts = {f"_first_{c}": first_row(F.col(c)) for c in kept}
    rows = Ordered(df, keys, order, hot).running(_value=spec(F.col(field)), **firsts).rows()
    rows = rows.withColumns({field: F.col("_value"), **{c: F.col(f"_first_{c}") for c in kept}})
    return rows.drop("_value", *firsts)


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    field: str,
    kept: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Running sum of ``field`` per key; ``kept`` columns show the key's first record."""
    return _rolling(df, keys, order, field, running_sum, kept, hot)


def rolling_min(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    field: str,
    kept: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Running minimum of ``field`` per key; ``kept`` columns show the key's first record.

    This is the minimum of the field, not the record that holds it. It is also the reduction whose
    function takes the smaller value and leaves the rest as it was.
    """
    return _rolling(df, keys, order, field, running_min, kept, hot)


def rolling_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotKeys | None = None
) -> DataFrame:
    """The number of the row within its key, as ``count``."""
    return Ordered(df, keys, order, hot).running(count=running_count()).rows()


def rolling_concat(df: DataFrame, keys: Sequence[str], order: Sequence[str], field: str) -> DataFrame:
    """Running concatenation of an array column per key.

    Row i of a key holds i lists by definition, so the output is quadratic in the size of a key
    and no plan makes it smaller; use it for keys with few rows, and :func:`rolling_elements` for others.
    """
    over = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(field, F.flatten(F.collect_list(field).over(over)))


def rolling_elements(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, hot: HotKeys | None = None
) -> DataFrame:
    """The running concatenation of an array column, with every element once.

    Gives keys, order columns, ``element``, its ``place`` in the list of the whole key (from 0) and ``size``, the length of
    the list so far at its row. The list of a row is the places below its ``size``: a range of this
    table, which has as many rows as there are elements. Rows with no elements give none. ``order`` is unique within a key.
    """
    n = F.coalesce(F.size(field), F.lit(0)).cast("bigint")
    n = F.when(F.col(field).isNull(), F.lit(0).cast("bigint")).otherwise(n)
    rows = Ordered(df.select(*keys, *order, field), keys, order, hot).running(size=running_sum(n)).rows()
    found = rows.select(*keys, *order, "size", n.alias("_n"), F.posexplode(field).alias("_pos", "element"))
    return found.select(*keys, *order, "element", (F.col("size") - F.col("_n") + F.col("_pos")).alias("place"), "size")


def retract_changelog(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, hot: HotKeys | None = None
) -> DataFrame:
    """The changelog of ``min, max GROUP BY keys`` as rows are added in order.

    The first row of a key adds its result; later ones take the old result back and add the new
    one, or give nothing if it did not change. ``change`` orders the two within an input row. NULL values
    change nothing; of NULLs alone both results are NULL.
    """
    v = F.col(value).cast("bigint")
    rows = (
        Ordered(df, keys, order, hot)
        .running(
            _x=running_min(v),
            _y=running_max(v),
            _old_x=running_min(v, inclusive=False),
            _old_y=running_max(v, inclusive=False),
            _before=running_count(inclusive=False),
        )
        .rows()
    )
    old = F.struct(F.lit(0).alias("change"), F.lit(False).alias("is_add"), F.col("_old_x").alias("x"), F.col("_old_y").alias("y"))
    new = F.struct(F.lit(1).alias("change"), F.lit(True).alias("is_add"), F.col("_x").alias("x"), F.col("_y").alias("y"))
    is_first = F.coalesce(F.col("_before"), F.lit(0)) == 0
    changed = ~(F.col("_x").eqNullSafe(F.col("_old_x")) & F.col("_y").eqNullSafe(F.col("_old_y")))
    changes = F.when(is_first, F.array(new)).when(changed, F.array(old, new))
    return rows.withColumn("_c", F.explode(changes)).select(*keys, *order, "_c.*")
