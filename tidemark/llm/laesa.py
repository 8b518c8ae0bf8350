"""Vector codes by exact integer product quantisation, with distances pruned by pivots.

Components become integers, and a vector is cut into equal consecutive parts. Every part position has a
codebook, improved in rounds: each part goes to its nearest entry, then each entry becomes the floor of the mean
of its parts. All of it is integer arithmetic, so the result does not depend on how the rows are dealt out.

Distances are saved the LAESA way. A few entries of the first codebook are pivots for good: the distance
of every part to them is computed once and written beside the integers. In a round only the entries' distances
to the pivots are new (16 x pivots numbers); by the triangle inequality a part is at least
``max |d(part, pivot) - d(pivot, entry)|`` from an entry. Entries are met in the order of that bound, and a part is
done when the next bound is beyond the best exact distance. Bounds are doubles with a margin for rounding
(``MARGIN``); whatever they let through is compared as integers.

A round is one pass over the written table: tasks add up their own parts by entry, Spark adds those sums, and
the driver reads one number per codebook component. No rows are shuffled but for the totals by label at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.vectors import blobs, finite, scaled, unblobbed, usual_length

FACTOR = 4096

#: How far rounding may take a bound, as a share of the distances it comes from.
MARGIN = 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows; integers of any size where int64 would not hold them."""
    reach = int(np.max(np.abs(a), initial=0)) + int(np.max(np.abs(b), initial=0))
    if reach * reach * max(a.shape[-1], 1) >= 2**63:
        a, b = a.astype(object), b.astype(object)
    difference = a - b
    return (difference * difference).sum(axis=-1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all of ``b`` as doubles."""
    found = [np.sqrt(np.asarray(squared(a, row[None, :]), float)) for row in b]
    return np.stack(found, axis=1) if found else np.zeros((len(a), 0))


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` entries far from one another: the first, then always the one farthest from those chosen."""
    chosen = [0][: min(n, len(entries))]
    while len(chosen) < min(n, len(entries)):
        nearest = distances(entries, entries[chosen]).min(axis=1)
        if not nearest.max():
            break
        chosen.append(int(nearest.argmax()))
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance, evaluations): the nearest entry of every row, ties to the lower index.

    ``to_pivots`` are the rows' distances to the pivots. ``evaluations`` counts exact distances.
    """
    between = distances(pivots, entries)
    bound = np.zeros((len(x), len(entries)))
    for own, other in zip(to_pivots.T, between):
        own, other = own[:, None], other[None, :]
        np.maximum(bound, np.abs(own - other) - MARGIN * (own + other), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    bound = bound * bound * (1 - MARGIN)
    index = order[:, 0].copy()
    best = squared(x, entries[index])
    evaluations = len(x)
    for rank in range(1, len(entries)):
        open_rows = np.flatnonzero(bound[:, rank] <= best.astype(float))
        if not len(open_rows):
            break
        evaluations += len(open_rows)
        entry = order[open_rows, rank]
        found = squared(x[open_rows], entries[entry])
        if found.dtype == object:
            best = best.astype(object)
        nearer = (found < best[open_rows]) | ((found == best[open_rows]) & (entry < index[open_rows]))
        index[open_rows[nearer]] = entry[nearer]
        best[open_rows[nearer]] = found[nearer]
    return index, best, evaluations


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part position, [parts, entries, components of a part], and the pivots, a list by part."""

    entries: np.ndarray
    pivots: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all integers by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Quantiser:
    """The written table of integer vectors with their pivot distances, and the passes over it."""

    def __init__(self, rows: DataFrame, width: int, parts: int, entries: np.ndarray, pivots: int):
        self.width, self.parts, self.part = width, parts, -(-width // parts)
        self.start = entries
        self.pivots = [choose_pivots(entries[j], pivots) for j in range(parts)]
        self.rows = staged(self._measured(rows), "laesa-parts")

    def _measured(self, rows: DataFrame) -> DataFrame:
        """(key, label, x, to_pivots): padded integers and the distances of each part to its pivots, computed once."""
        width, parts, pivots = self.width, self.parts, self.pivots
        kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "label")]

        def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _padded(scaled(batch.column(2), width, FACTOR), parts)
                cut = x.reshape(len(x), parts, -(-width // parts))
                far = [distances(cut[:, j], pivots[j]) for j in range(parts)]
                columns = [batch.column(0), batch.column(1), blobs(x), blobs(np.concatenate(far, axis=1))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "x", "to_pivots"])

        return rows.mapInArrow(measured, f"key {kinds[0]}, label {kinds[1]}, x binary, to_pivots binary")

    def _assigner(self, entries: np.ndarray):
        parts, part, pivots = self.parts, self.part, self.pivots
        ends = np.cumsum([len(p) for p in pivots])

        def assign(x: pa.Array, to_pivots: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            cut = unblobbed(x, parts * part).reshape(len(x), parts, part)
            far = np.split(unblobbed(to_pivots, int(ends[-1]), np.float64), ends[:-1], axis=1)
            for j in range(parts):
                index, best, _ = nearest(cut[:, j], far[j], pivots[j], entries[j])
                yield cut[:, j], index, best

        return assign

    def improved(self, entries: np.ndarray) -> np.ndarray:
        """One round: entries as the floor of the mean of the parts nearest to them; unused ones stay."""
        assign, (parts, size, part) = self._assigner(entries), entries.shape
        schema = "part int, entry int, at int, n bigint, total decimal(38,0)"

        def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((parts, size), np.int64)
            totals = np.zeros((parts, size, part), object)
            for batch in batches:
                for j, (x, index, _) in enumerate(assign(batch.column(0), batch.column(1))):
                    counts[j] += np.bincount(index, minlength=size)
                    high, low = x >> 32, x & 0xFFFFFFFF
                    for entry in np.unique(index):
                        own = index == entry
                        totals[j, entry] += high[own].sum(axis=0).astype(object) * 2**32 + low[own].sum(axis=0).astype(object)
            j, entry, at = (i.ravel().astype(np.int32) for i in np.indices(totals.shape))
            columns = [
                pa.array(j),
                pa.array(entry),
                pa.array(at),
                pa.array(np.repeat(counts.ravel(), part)),
                pa.array([Decimal(int(t)) for t in totals.ravel()], pa.decimal128(38, 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "at", "n", "total"])

        sums = self.rows.select("x", "to_pivots").mapInArrow(added, schema).groupBy("part", "entry", "at")
        new = entries.copy()
        for r in sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            if r["n"]:
                new[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
        return new

    def coded(self, entries: np.ndarray) -> DataFrame:
        """(key, label, code, error): two hex digits per part, and the squared distances summed over parts."""
        assign, parts = self._assigner(entries), self.parts
        kinds = [self.rows.schema[c].dataType.simpleString() for c in ("key", "label")]

        def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = np.zeros((batch.num_rows, parts), np.uint8)
                error = np.zeros(batch.num_rows, object)
                for j, (_, index, best) in enumerate(assign(batch.column(2), batch.column(3))):
                    codes[:, j] = index
                    error += best.astype(object)
                columns = [
                    batch.column(0),
                    batch.column(1),
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array([Decimal(e) if e < 10**38 else None for e in error], pa.decimal128(38, 0)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "label", "code", "error"])

        schema = f"key {kinds[0]}, label {kinds[1]}, code string, error decimal(38,0)"
        return self.rows.mapInArrow(assigned, schema)


def _padded(x: np.ndarray, parts: int) -> np.ndarray:
    """Zeros at the end, so that the parts are equal."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % parts)))


def compress(
    vectors: DataFrame,
    parts: int = 8,
    size: int = 16,
    rounds: int = 6,
    pivots: int = 4,
    key: str = "vec_id",
    label: str = "label",
    column: str = "embedding",
) -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) of every vector.

    Codebooks start as the parts of the ``size`` (256 at most) smallest keys, ascending, ties by the vector,
    null keys last; fewer rows give fewer entries. ``error`` is the sum of the final squared distances in units
    of 1/4096, ``label_error`` its sum over equal labels, nulls together; either is null where a bigint does
    not hold it. Null vectors and those with a null or non-finite component give no rows, nor do vectors of
    another length than most (ties: than the longest). A length that does not divide is filled up with zeros; a
    component beyond 2**62 / 4096 counts as that bound. Repeated rows each count and each come back. A tie between
    entries goes to the lower one. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    if not 1 <= size <= 256:
        raise ValueError("a code has one byte per part")
    spark = vectors.sparkSession
    kept = vectors.filter(finite(F.col(column)))
    width = usual_length(kept, column)
    rows = kept.filter(F.size(column) == (-1 if width is None else width)).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(column).cast("array<double>").alias("v")
    )
    if width is None:
        kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "label")]
        schema = f"key {kinds[0]}, label {kinds[1]}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        empty = spark.createDataFrame([], schema)
        return empty.withColumnsRenamed({"key": key, "label": label})
    first = rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(size).select("v").collect()
    start = scaled(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width, FACTOR)
    entries = _padded(start, parts).reshape(len(start), parts, -(-width // parts)).transpose(1, 0, 2).copy()
    quantiser = Quantiser(rows, width, parts, entries, pivots)
    for _ in range(rounds):
        entries = quantiser.improved(entries)
    books = Codebooks(entries, quantiser.pivots)

    coded = staged(quantiser.coded(entries), "laesa-codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("total")).withColumnRenamed("label", "of")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("key").alias(key),
        F.col("label").alias(label),
        "code",
        F.col("error").try_cast("bigint").alias("error"),
        F.col("total").try_cast("bigint").alias("label_error"),
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
