"""Tables in and out of Spark, shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Rows of a batch that are taken into Python together, and rows and bytes of a batch that Spark sends there.
SLICE_ROWS, BATCH_ROWS, BATCH_BYTES = 256, 1_000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in small batches.

    Each task holds a batch twice outside the heap, there and back, and with what a growing buffer leaves over, and its
    Python worker once or twice more: ten thousand long texts take hundreds of megabytes of an executor.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``, or else the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def staged(df: DataFrame, label: str, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without computing ``df`` again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(batches: Iterable[pa.RecordBatch], max_chars: int = 4_000_000) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) lists of a bounded number of characters from batches of (id, text); null text is empty.

    Only some rows of a batch are Python's strings at a time: those of a list, and up to ``SLICE_ROWS`` more.
    """
    for batch in batches:
        ids, texts, size = [], [], 0
        for at in range(0, batch.num_rows, SLICE_ROWS):
            rows = batch.slice(at, SLICE_ROWS)
            for key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                ids.append(key)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= max_chars:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def merged(batches: Iterable[pa.RecordBatch], rows: int = 20_000, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: small ones are joined until they hold ``rows`` rows or ``size`` bytes."""
    held, n, held_size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        held_size += batch.nbytes
        if n >= rows or held_size >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, held_size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
