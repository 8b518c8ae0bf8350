"""Embedding columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, one of them not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors of an Arrow list column as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def balanced(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that its largest component is near one.

    Squares of very large or small components stay doubles; cosines keep every bit, as powers of two are exact.
    """
    _, power = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -power[:, None])


def ordered_sum(values: np.ndarray) -> np.ndarray:
    """Row sums of doubles added from left to right, so equal rows have equal sums wherever they are."""
    total = np.zeros(len(values))
    for column in values.T:
        total += column
    return total


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices."""
    norms = np.sqrt(ordered_sum(a * a)) * np.sqrt(ordered_sum(b * b))
    return ordered_sum(a * b) / norms


def finite(embedding: Column) -> Column:
    """Whether a vector is there and all its components are finite; a vector of zeros or of no components is."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(embedding.isNotNull() & ~bad, F.lit(False))


def usual_length(vectors: DataFrame, column: str) -> int | None:
    """The number of components most vectors have, ties to the larger; None without vectors."""
    counts = vectors.groupBy(F.size(column).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n"), F.desc("size")).first()
    return None if most is None else most["size"]


def scaled(column: pa.Array, width: int, factor: int, shift: int = 0) -> np.ndarray:
    """floor(factor * x) + shift of vectors of doubles as rows of int64; beyond 2**62 the nearest bound."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * factor), -(2.0**62), 2.0**62).astype(np.int64) + shift


def blobs(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    n, size = len(values), values.shape[1] * values.itemsize
    offsets = np.arange(n + 1, dtype=np.int32) * size
    data = np.ascontiguousarray(values).tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def unblobbed(column: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    """The matrix whose rows ``blobs`` packed."""
    if not width or not len(column):
        return np.zeros((len(column), width), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), width)
