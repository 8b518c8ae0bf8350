"""Headline queries and the plain forms they replace; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs of which
the median counts, after one run to warm up. Results are computed in full and written nowhere.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import catalog, model
from tidemark.operators import rank
from tidemark.plans.panes import count_rows, sliding_plain
from tidemark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "sql_top_items",
    "top_items",
    "top_urls",
    "marketing_by_channel",
    "uv_exact",
    "uv_bitmap",
    "uv_approx",
    "tumble_avg",
    "word_count_window",
    "rolling_word_count",
    "rolling_sum",
    "retract_changelog",
    "window_early_fire",
    "interval_join",
    "window_join",
    "reconcile_outer",
    "switch_filter",
    "temp_diff",
    "temp_rise_alert",
    "anchored_window_count",
    "login_fail_window",
    "order_timeout_state",
    "cep_times3",
    "cep_order_timeout",
    "late_update_window",
    "udf_hash_code",
    "top2_per_key",
    "sink_upsert_latest",
]


def _ranked_plainly(df: DataFrame, item: str, size: str, slide: str, n: int) -> DataFrame:
    counts = sliding_plain(df, [item], "ts", size, slide, count=count_rows())
    return rank.top_n(counts, ["window_end"], [F.col("count").desc(), F.col(item)], n, "row_num")


def plain_top_items(spark, sf_dir):
    views = model.user_behavior(model.table(spark, sf_dir, "events")).filter("behavior = 'view'")
    return _ranked_plainly(views, "item_id", "1 hour", "5 minutes", 3)


def plain_top_urls(spark, sf_dir):
    log = catalog.src_weblog_parse(spark, sf_dir)
    return _ranked_plainly(log, "url", "10 minutes", "5 seconds", 5)


def plain_interval_join(spark, sf_dir):
    orders, items = (model.table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    near = "l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY"
    return orders.join(items, (F.col("o_orderkey") == F.col("l_orderkey")) & F.expr(near)).select(
        "o_orderkey", "o_orderdate", "l_linenumber", "l_shipdate"
    )


def plain_rolling_sum(spark, sf_dir):
    over = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = model.user_behavior(model.table(spark, sf_dir, "events"))
    return rows.select(
        "event_id", "user_id", F.sum("item_id").over(over).alias("item_id"), F.first("behavior").over(over).alias("behavior")
    )


def plain_temp_diff(spark, sf_dir):
    over = Window.partitionBy("id").orderBy("ts", "event_id")
    rows = model.sensor_readings(model.table(spark, sf_dir, "events"))
    diff = F.abs(F.col("temperature") - F.lag("temperature", 1, 0.0).over(over))
    return rows.withColumn("diff", diff).filter("diff > 1.7")


PLAIN = [plain_top_items, plain_top_urls, plain_interval_join, plain_rolling_sum, plain_temp_diff]


def timed(spark, build) -> float:
    """Median seconds to build, plan and compute a query."""
    took = []
    for _ in range(RUNS + 1):
        began = time.perf_counter()
        build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - began)
    return round(statistics.median(took[1:]), 3)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    plain = {f.__name__: f for f in PLAIN if not sys.argv[1:] or f.__name__ in names}
    queries = {n: timed(spark, catalog.QUERIES[n]) for n in names if n in catalog.QUERIES}
    baseline = {n: timed(spark, f) for n, f in plain.items()}
    line = {
        "metric": "total of median query seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "plain_forms": baseline,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
        "runs": RUNS,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
