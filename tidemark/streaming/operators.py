"""Streaming forms. Where the batch operator already works on streams, it is used as it is."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.rank import top_n
from tidemark.operators.windows import tumbling
from tidemark.plans.durations import floor_to, interval, micros, position
from tidemark.plans.panes import before_fan_out, count_rows, sliding_plain
from tidemark.session import shared_dir
from tidemark.sinks.streams import route, to_table


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Event times as timestamps with a watermark ``delay`` behind the latest.

    A delay of zero is for ascending times, a longer one for times out of order by up to that.
    """
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


# A time after all others, from which the watermark lets every window and timer of a bounded stream fire.
END = "9000-01-01 00:00:00"


def with_end(rows: DataFrame, ts: str) -> DataFrame:
    """A bounded stream and one row at ``END`` whose other columns are NULL.

    Run to its end, the stream's watermark passes all other rows, as at the end of bounded input. The
    last row's own windows and timers stay in the state. Call it before the watermark is set, after
    filters, and on both sides of a join.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, "end")
    last = [F.lit(END if f.name == ts else None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    spark.range(1).select(*last).write.parquet(path)
    return rows.unionByName(spark.readStream.schema(rows.schema).parquet(path))


def tumble_count(df: DataFrame, keys: Sequence[str], ts: str, size: str) -> DataFrame:
    """Counts per key and window, each emitted once when the watermark passes its end."""
    return tumbling(df, keys, ts, size, F.count(F.lit(1)).alias("count"))


def unique_visitors(df: DataFrame, user: str, ts: str, size: str) -> DataFrame:
    """Distinct users per window: one state row per (window, user), then a count."""
    window = F.window(ts, f"{micros(size)} microseconds")
    once = df.select(user, window.alias("_w")).dropDuplicates([user, "_w"])
    counts = once.groupBy("_w").agg(F.count(F.lit(1)).alias("uv"))
    return counts.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "uv")


# Sums of panes that a task holds at a time.
CELLS = 1 << 20


def sliding_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str, slide: str, together: str | None = None) -> DataFrame:
    """Counts per key and sliding window, by panes if the slide divides the size.

    Rows are counted per pane, and closed panes per window: a row touches one state entry, not one
    for each window it is in. A window is out when the watermark passes its end. With ``together``, windows that start in
    the same stretch of that length are out when the last of them is closed, and a pane is shuffled once or
    twice for each stretch, not for each window.
    """
    long, step = micros(size), micros(slide)
    if long % step:
        return sliding_plain(df, keys, ts, size, slide, count=count_rows())
    if together is not None:
        return _stretch_counts(_stretches(df, keys, ts, long, step, micros(together)), keys, long, step, micros(together))
    panes = _panes(df, keys, ts, step)
    window = F.window(F.window_time("_pane"), f"{long} microseconds", f"{step} microseconds")
    counts = panes.groupBy(*keys, window.alias("_w")).agg(F.sum("_n").alias("count"))
    return counts.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "count")


def _panes(df: DataFrame, keys: Sequence[str], ts: str, step: int) -> DataFrame:
    return df.groupBy(*keys, F.window(ts, f"{step} microseconds").alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))


def _stretches(df: DataFrame, keys: Sequence[str], ts: str, long: int, step: int, together: int) -> DataFrame:
    """A row per key and stretch of windows: where it begins, and all panes of its windows with their counts."""
    if together % step:
        raise ValueError("the slide must divide the stretch of windows that are out together")
    stretch = F.window(F.window_time("_pane"), f"{together + long - step} microseconds", f"{together} microseconds")
    pane = F.struct(F.unix_micros("_pane.start").alias("at"), F.col("_n").alias("n"))
    found = _panes(df, keys, ts, step).groupBy(*keys, stretch.alias("_w")).agg(F.collect_list(pane).alias("_panes"))
    return found.select(*keys, F.unix_micros("_w.start").alias("_first"), "_panes")


def _stretch_counts(stretches: DataFrame, keys: Sequence[str], long: int, step: int, together: int, n: int | None = None) -> DataFrame:
    """Counts of the windows of stretches: differences of running sums over a stretch's panes.

    With ``n``, the rows of a stretch that follow each other are compared, and of each window only the ``n``
    largest counts among some of them are kept, ties to the earlier row: no row of a window's first ``n`` is lost.
    """
    held, width = long // step, together // step

    def run(batches):
        for batch in batches:
            many = max(1, CELLS // (held + width))
            for part in (batch.slice(at, many) for at in range(0, batch.num_rows, many)):
                first, lists = part.column("_first").to_numpy(), part.column("_panes")
                row = np.repeat(np.arange(len(first)), pc.list_value_length(lists).to_numpy())
                panes = lists.flatten()
                place = (pc.struct_field(panes, "at").to_numpy() - first[row]) // step
                sums = np.zeros((len(first), held + width), np.int64)
                sums[row, place + 1] = pc.struct_field(panes, "n").to_numpy()
                sums.cumsum(1, out=sums)
                counts = sums[:, held:] - sums[:, :width]
                shown = counts > 0
                if n is not None:
                    ends = [*np.flatnonzero(first[1:] != first[:-1]) + 1, len(first)]
                    for a, b in zip([0, *ends], ends, strict=False):
                        best, among = np.argsort(-counts[a:b], 0, "stable")[:n], np.zeros((b - a, width), bool)
                        np.put_along_axis(among, best, True, 0)
                        shown[a:b] &= among
                row, place = np.nonzero(shown)
                own = [part.column(k).take(pa.array(row)) for k in keys]
                yield pa.RecordBatch.from_arrays([*own, pa.array(first[row] + place * step), pa.array(counts[row, place])], [*keys, "_start", "count"])

    fields = ", ".join(f"`{k}` {stretches.schema[k].dataType.simpleString()}" for k in keys)
    counts = stretches.mapInArrow(run, f"{fields}, _start bigint, count bigint")
    start, end = (F.timestamp_micros(F.col("_start") + more) for more in (0, long))
    return counts.select(*keys, start.alias("window_start"), end.alias("window_end"), "count")


def rank_batches(
    df: DataFrame,
    item: str,
    ts: str,
    size: str,
    slide: str,
    n: int,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    together: str | None = None,
) -> StreamingQuery:
    """Top ``n`` items per sliding window, handed to ``write`` batch by batch.

    In append mode all counts of a window leave the state in the same batch, so ranking inside the
    batch is exact, and no list of all items of a window is ever built. ``together`` is that of ``sliding_counts``: items
    of a stretch meet before their panes become windows, and only counts that may rank are shuffled as rows.
    """
    long, step = micros(size), micros(slide)
    in_stretches = together is not None and long % step == 0
    found = _stretches(df, [item], ts, long, step, micros(together)) if in_stretches else sliding_counts(df, [item], ts, size, slide)

    def ranked(batch: DataFrame, number: int) -> None:
        order = [F.col("count").desc(), F.col(item).asc()]
        if in_stretches:
            near = before_fan_out(batch, "_first").sortWithinPartitions("_first", F.col(item).asc())
            batch = _stretch_counts(near, [item], long, step, micros(together), n)
        write(top_n(batch, ["window_end"], order, n, "row_num").drop("window_start"), number)

    return (
        found.writeStream.outputMode("append")
        .foreachBatch(ranked)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: str, upper: str
) -> DataFrame:
    """Pairs of a key with ``right_ts`` in [left_ts + lower, left_ts + upper]; both have watermarks."""
    other = right.withColumnRenamed(key, "_key")
    near = F.col(right_ts).between(F.col(left_ts) + interval(lower), F.col(left_ts) + interval(upper))
    return left.join(other, (F.col(key) == F.col("_key")) & near).drop("_key")


def reconcile(orders: DataFrame, pays: DataFrame, key: str, order_ts: str, pay_ts: str, patience: str) -> DataFrame:
    """Matched pairs, and the orders and payments whose partner did not come in time."""
    other = pays.withColumnRenamed(key, "_key")
    wait = interval(patience)
    near = F.col(pay_ts).between(F.col(order_ts) - wait, F.col(order_ts) + wait)
    joined = orders.join(other, (F.col(key) == F.col("_key")) & near, "full_outer")
    kind = F.when(F.col("_key").isNull(), "unmatched_order").when(F.col(key).isNull(), "unmatched_pay")
    return joined.select(
        F.coalesce(key, "_key").alias(key),
        F.col(order_ts).alias("order_at"),
        F.col(pay_ts).alias("pay_at"),
        F.coalesce(kind, F.lit("matched")).alias("output"),
    )


def early_counts(df: DataFrame, keys: Sequence[str], ts: str, size: str, every: str, write: Callable, checkpoint: str) -> StreamingQuery:
    """Running counts of open windows, sent to ``write`` each trigger interval as they change."""
    counts = tumble_count(df, keys, ts, size)
    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def updating_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    delay: str,
    lateness: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Window counts that are sent again when records up to ``lateness`` late change them.

    ``df`` has event times and no watermark yet: the state is kept for both durations.
    """
    kept = df.withWatermark(ts, f"{micros(delay) + micros(lateness)} microseconds")
    return (
        tumble_count(kept, keys, ts, size)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def route_late(
    df: DataFrame,
    ts: str,
    delay: str,
    sinks: Mapping[str, Callable[[DataFrame], None]],
    tops: str,
    checkpoint: str,
    size: str | None = None,
) -> StreamingQuery:
    """Send records to the ``main`` or the ``late`` sink before any stateful step could drop them.

    The watermark of a batch is the largest event time of the batches before it minus ``delay``,
    as Spark's own. A record is late when it is older or, with ``size``, when its window has
    closed. The largest time so far is one row per batch under ``tops``, a folder all executors
    reach, so a batch that is tried again is split the same way.
    """

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = position(batch, ts)
        before = None
        if number:
            before = spark.read.parquet(f"{tops}/batch={number - 1}").first()["top"]
        top = batch.agg(F.greatest(F.max(at), F.lit(before).cast("bigint")).alias("top"))
        top.write.mode("overwrite").parquet(f"{tops}/batch={number}")
        late = F.lit(False)
        if before is not None:
            mark = before - micros(delay)
            late = at < mark if size is None else floor_to(at, micros(size)) + micros(size) <= mark
        route(batch.withColumn("output", F.when(late, "late").otherwise("main")), sinks)

    return (
        df.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finished(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what its source holds now and read the table it wrote."""
    path = shared_dir(spark, label)
    query = to_table(stream, path, shared_dir(spark, f"{label}-checkpoint"))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
