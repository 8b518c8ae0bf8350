"""Windows that fire again for late records, over batches that arrive out of order, against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sinks.streams import to_table
from tidemark.streaming import operators
from tidemark.streaming.windows import late_updates

SCHEMA = "k string, seq bigint, at bigint, count int"  # a further column named as one of the result
SIZE, DELAY = 60, 20


def expected(batches, lateness):
    """Rows of (key, window end, fired by, update, count) in plain Python, seconds as times."""
    top, counts, fired, out = None, defaultdict(int), set(), []
    for batch in batches:
        mark, late = None if top is None else top - DELAY, defaultdict(list)
        for k, seq, at, _ in batch:
            window = (k, at // SIZE * SIZE + SIZE)
            if mark is None or window[1] > mark:
                counts[window] += 1
            elif window[1] > mark - lateness:
                late[window].append(seq)
        for window in [w for w in counts if mark is not None and w[1] <= mark and w not in fired]:
            fired.add(window)
            out.append((*window, None, False, counts[window]))
        for window, ties in late.items():
            fired.add(window)
            for tie in sorted(ties, key=lambda t: (t is not None, t or 0)):
                counts[window] += 1
                out.append((*window, tie, counts[window] > 1, counts[window]))
        top = max(r[2] for r in batch) if top is None else max(top, *[r[2] for r in batch])
    out += [(*w, None, False, n) for w, n in counts.items() if w not in fired]
    return sorted(out, key=repr)


@pytest.mark.parametrize("lateness", [0, 45, 600])
def test_updates(spark, lateness):
    rng = random.Random(lateness)
    batches, seq = [], 0
    for b in range(5):
        batch = []
        for _ in range(60):
            at = 10_000 + max(0, b * 100 + rng.randint(-250, 100))
            batch.append((rng.choice(["a", "b", None]), None if rng.random() < 0.05 else seq, at, 1))
            seq += 1
        batches.append(batch + batch[:2])  # repeated rows
    folder, out, checkpoint = (shared_dir(spark, x) for x in ("updates-in", "updates-out", "updates-checkpoint"))
    schema = spark.createDataFrame([], SCHEMA).withColumn("ts", F.timestamp_seconds("at")).schema
    for i, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, SCHEMA).withColumn("ts", F.timestamp_seconds("at"))
        if i == len(batches) - 1:
            last = [F.lit(operators.END if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in schema]
            rows = rows.unionByName(spark.range(1).select(*last))
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        found = late_updates(stream, ["k"], "ts", "seq", f"{SIZE} seconds", f"{DELAY} seconds", f"{lateness} seconds")
        to_table(found, out, checkpoint).awaitTermination()
    got = spark.read.schema(found.schema).parquet(out).withColumn("window_end", F.unix_seconds("window_end")).collect()
    assert sorted(map(tuple, got), key=repr) == expected(batches, lateness)
    assert lateness == 0 or any(r.is_update for r in got)
