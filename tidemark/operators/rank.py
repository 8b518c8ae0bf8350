"""Top-N rankings over windowed counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.panes import count_rows, sliding


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows per group; each map task drops what cannot rank before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))


def top_per_window(
    df: DataFrame, item: str, ts: str, size: str | int, slide: str | int, n: int
) -> DataFrame:
    """Sliding counts per item, then the ``n`` largest per window end; ties to the smaller item."""
    counts = sliding(df, [item], ts, size, slide, count=count_rows())
    ranked = top_n(counts, ["window_end"], [F.col("count").desc(), F.col(item).asc()], n, "row_num")
    return ranked.select("window_end", item, "count", "row_num")


def top_items(
    behavior: DataFrame, n: int = 3, size: str = "1 hour", slide: str = "5 minutes", view: str = "pv"
) -> DataFrame:
    """Most viewed items of the last hour, every five minutes."""
    views = behavior.filter(F.col("behavior") == view)
    return top_per_window(views, "item_id", "ts", size, slide, n)


def top_urls(log: DataFrame, n: int = 5, size: str = "10 minutes", slide: str = "5 seconds") -> DataFrame:
    """Most requested URLs of the last ten minutes, every five seconds."""
    return top_per_window(log, "url", "ts", size, slide, n)


def report(ranked: DataFrame, item: str) -> DataFrame:
    """One text block per window: its end, then a line per place."""
    line = F.struct(
        "row_num",
        F.concat(
            F.lit("No."), F.col("row_num"), F.lit(f": {item} = "), F.col(item), F.lit(" count = "), F.col("count")
        ).alias("line"),
    )
    lines = F.transform(F.sort_array(F.collect_list(line)), lambda s: s["line"])
    rule = F.lit("=" * 39)
    head = F.concat(F.lit("time: "), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"))
    return ranked.groupBy("window_end").agg(
        F.concat_ws("\n", rule, head, F.concat_ws("\n", lines), rule).alias("report")
    )


# Views per item and five-minute pane first, then the twelve one-hour windows of each pane.
TOP_ITEMS_SQL = """
WITH panes AS (
  SELECT window(ts, '5 minutes').end AS pane_end, item_id, count(*) AS n
  FROM {source} WHERE behavior = '{view}' GROUP BY ALL
), counts AS (
  SELECT item_id, window_end, sum(n) AS icount
  FROM (SELECT item_id, n,
               explode(sequence(pane_end, pane_end + INTERVAL '55' MINUTE, INTERVAL '5' MINUTE)) AS window_end
        FROM panes)
  GROUP BY item_id, window_end
), ranked AS (
  SELECT window_end, item_id, icount,
         row_number() OVER (PARTITION BY window_end ORDER BY icount DESC, item_id) AS row_num
  FROM counts
)
SELECT window_end, item_id, icount, CAST(row_num AS bigint) AS row_num FROM ranked WHERE row_num <= 3
"""


def sql_top_items(spark: SparkSession, source: str, view: str = "pv") -> DataFrame:
    """The hot-item ranking as one SQL statement over a temporary view of behaviour rows."""
    return spark.sql(TOP_ITEMS_SQL.format(source=source, view=view))
