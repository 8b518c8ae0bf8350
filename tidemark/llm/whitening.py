"""Whitened embeddings: the leading components of a distributed covariance, each to unit variance.

1. Components become integers, and each distinct integer vector is fitted once: the table of distinct
   vectors is written to the shared folder, map-side combined first, so a group of copies moves as one row
   per task.
2. One pass gives its size and exact sums, the next the covariance: vectors are centred by the exact mean
   in integers before they are multiplied. Every task adds up its own products in blocks of rows of the matrix; blocks
   are added in shares of ``FAN_IN`` tasks and then over shares, one after the other, so a task holds two blocks.
3. The driver gets one matrix as wide as a vector is long and finds its leading eigenpairs (``spectrum``).
4. The projection is broadcast; its size is components x 16 doubles whatever the number of rows. One more pass
   over the fitted vectors measures the covariance of the result.

Every pass reads a written or given table, so a lost executor costs its tasks and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.spectrum import EPS, leading
from tidemark.llm.vectors import blobs, finite, scaled, unblobbed, usual_length

FACTOR, SHIFT = 64, 1_000_000

#: Rows of a matrix in a block, and tasks whose blocks are added at once.
BLOCK_ROWS, FAN_IN = 256, 64
LONG = 2**63


@dataclass(frozen=True)
class Whitening:
    """What a fit found: ``n`` distinct vectors, their exact sums, falling eigenvalues, and unit vectors as columns."""

    width: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def explained(self) -> np.ndarray:
        """The share of all variance in each component; NaN where nothing varies."""
        return self.values / self.trace if self.trace else np.full(len(self.values), np.nan)

    def varies(self) -> np.ndarray:
        """Which components have variance beyond rounding; the others can't be brought to one."""
        return self.values > self.width * EPS * self.trace

    def projection(self) -> np.ndarray:
        """Columns that take a centred vector to its whitened components; NaN where nothing varies."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varies(), self.vectors / np.sqrt(self.values), np.nan)


def integers(vectors: DataFrame, width: int, key: str, column: str) -> DataFrame:
    """(key, x): the vectors of ``width`` finite components as binaries of int64."""
    rows = vectors.filter(finite(F.col(column)) & (F.size(column) == width))
    rows = rows.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("v"))

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(batch.column(1), width, FACTOR, SHIFT)
            yield pa.RecordBatch.from_arrays([batch.column(0), blobs(x)], ["key", "x"])

    return rows.mapInArrow(packed, f"key {rows.schema['key'].dataType.simpleString()}, x binary")


def _size_and_sums(fit: DataFrame, width: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and the exact sum of every component: halves of 32 bits are added apart."""

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = unblobbed(batch.column(0), width)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        columns = [np.arange(width), np.full(width, n), high, low]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["at", "n", "high", "low"])

    parts = fit.mapInArrow(added, "at bigint, n bigint, high bigint, low bigint")
    totals = parts.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    found = {r["at"]: (r["n"], (int(r["high"]) << 32) + int(r["low"])) for r in totals.collect()}
    return (found[0][0] if found else 0), tuple(found[i][1] for i in range(width) if i in found)


def _centring(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as an integer and a rest below one: x minus the first is exact, and the rest is all but."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    rest = [float(Decimal(s - n * c) / Decimal(n)) for s, c in zip(sums, whole)]
    return np.array(whole, np.int64), np.array(rest)


def _products(fit: DataFrame, width: int, out: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of y yᵀ, y = ``centred(x)`` of ``out`` components.

    Blocks of rows of the sum are added over ``FAN_IN`` tasks, then over those; the driver gets one matrix.
    """

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out, out))
        for batch in batches:
            y = centred(unblobbed(batch.column(0), width))
            total += y.T @ y
        task = TaskContext.get().partitionId()
        for at in range(0, out, BLOCK_ROWS):
            yield block(at, task, total[at : at + BLOCK_ROWS])

    def block(at: int, share: int, values: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([at], pa.int64()), pa.array([share], pa.int64()), pa.array([values.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["at", "share", "block"])

    def added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for value in batch.column("block"):
                total = total + np.frombuffer(value.as_py())
        yield block(key[0].as_py(), key[1].as_py(), total)

    schema = "at bigint, share bigint, block binary"
    parts = fit.mapInArrow(own, schema)
    for share in (F.floor(F.col("share") / FAN_IN), F.lit(0)):
        parts = parts.withColumn("share", share.cast("bigint")).groupBy("at", "share").applyInArrow(added, schema)
    blocks = parts.collect()
    rows = [np.frombuffer(b["block"]).reshape(-1, out) for b in sorted(blocks, key=lambda b: b["at"])]
    return np.concatenate(rows) if rows else np.zeros((out, out))


def fit(vectors: DataFrame, components: int = 16, key: str = "vec_id", column: str = "embedding") -> Whitening | None:
    """Fit on each distinct integer vector once; None if no vector is left."""
    width = usual_length(vectors.filter(finite(F.col(column))), column)
    if not width:
        return None
    distinct = staged(integers(vectors, width, key, column).select("x").distinct(), "whitening-fit")
    n, sums = _size_and_sums(distinct, width)
    whole, rest = _centring(n, sums)
    covariance = _products(distinct, width, width, lambda x: (x - whole) - rest) / n
    values, found = leading(covariance, components)
    model = Whitening(width, n, sums, values, found, float(np.trace(covariance)), 0.0)
    kept = model.projection()[:, model.varies()]
    error = 0.0
    if kept.shape[1]:
        # The exact mean is taken off before the products, so whitened vectors have none left.
        white = _products(distinct, width, kept.shape[1], lambda x: ((x - whole) - rest) @ kept) / n
        error = float(np.max(np.abs(white - np.eye(kept.shape[1]))))
    return Whitening(width, n, sums, values, found, model.trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The sum over components of (n x - S)² of every row, exact; None where a long does not hold it."""
    about = np.zeros(len(x))
    total = np.zeros(len(x), np.uint64)
    for i, s in enumerate(sums):
        # Products modulo 2**64 are exact as long as the sum fits, which the doubles tell.
        own = x[:, i].astype(np.uint64) * np.uint64(n % 2**64) - np.uint64(s % 2**64)
        total += own * own
        about += (x[:, i].astype(float) * n - s) ** 2
    found: list[int | None] = total.astype(np.int64).tolist()
    rough = np.abs(x).max(axis=1, initial=0).astype(float) * n * 1e-15
    for i in np.flatnonzero(about + 2 * len(sums) * rough * (np.sqrt(about) + rough) > 0.99 * LONG):
        exact = sum((int(v) * n - s) ** 2 for v, s in zip(x[i], sums))
        found[i] = exact if exact < LONG else None
    return found


def transform(vectors: DataFrame, model: Whitening | None, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every vector of the fitted length."""
    kind = vectors.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    rows = integers(vectors, model.width, key, column)
    k = len(model.values)
    shared = vectors.sparkSession.sparkContext.broadcast((model, model.projection(), *_centring(model.n, model.sums)))

    def projected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, projection, whole, rest = shared.value
        for batch in batches:
            x = unblobbed(batch.column(1), model.width)
            white = (((x - whole) - rest) @ projection).ravel()
            each = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(deviations(x, model.n, model.sums), pa.int64())
            explained = np.tile(model.explained(), len(x))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, model.n)),
                deviation.take(each),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained, mask=np.isnan(explained)),
                pa.array(np.full(len(x) * k, model.identity_error)),
            ]
            names = ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(projected, schema).withColumnRenamed("key", key)


def whiten(vectors: DataFrame, components: int = 16, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The leading components of every vector, centred and scaled to unit variance: a row per vector and component.

    Null vectors and those with a null or non-finite component give no rows. Vectors of another length
    than most (ties: than the longest) can't be projected together and give none either. A repeated row
    gives its rows each time and is fitted once; equal eigenvalues take any orthonormal vectors, the same
    for all rows. A component without variance (fewer distinct vectors than components) has null
    ``whitened`` and is left out of ``identity_error``; without any variance ``explained`` is null.
    Null keys stay null. A deviation that a bigint does not hold is null; entries beyond 2**62 count as
    that bound. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    return transform(vectors, fit(vectors, components, key, column), key, column)
