"""Nearest neighbours by randomly rotated one-bit codes with error bounds and exact reranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from tidemark.llm.common import BATCH_BYTES
from tidemark.llm.vectors import balanced, blobs, cosine, matrix, ordered_sum, unblobbed

#: Vectors of a block, queries that meet the vectors together, and vectors that a task meets them with, at most.
BLOCK_ROWS, QUERY_ROWS, PART_ROWS = 8192, 32768, 32 * 8192
#: Bytes of each of them, at most: of vectors of many components there are fewer.
BLOCK_BYTES, QUERY_BYTES, PART_BYTES = 4 << 20, 16 << 20, 96 << 20
#: Vectors that give the first floors, and rows of a tile of estimates: vectors, queries.
FIRST_ROWS, TILE_ROWS, TILE_QUERIES = 512, 256, 2048
#: Bits of a code per component: vectors are padded with zeros before they are turned.
WIDEN = 8


def rotation(dim: int, seed: int, widen: int = WIDEN) -> np.ndarray:
    """The rows of a random orthogonal matrix of ``widen * dim`` that meet the components before the padding."""
    wide = dim * widen
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dim]


def codes(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and their inner products with what the signs stand for."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None] @ turn
    return np.packbits(unit > 0, axis=1), np.abs(unit).sum(1) / np.sqrt(unit.shape[1])


def decoded(packed: np.ndarray, scale: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """What codes stand for, turned back to as many components as the vectors have.

    Turned unit queries meet the signs as unit queries meet these, with a multiplication per component instead of per bit.
    """
    bits = turn.shape[1]
    signs = np.unpackbits(packed, axis=1, count=bits).astype(np.float32) * 2 - 1
    return signs @ turn.T.astype(np.float32) / (np.sqrt(bits) * scale).astype(np.float32)[:, None]


def bounds(scale: np.ndarray, bits: int, sigmas: float) -> np.ndarray:
    """The bound on the error of each code: it is close to normal with deviation sqrt((1 - scale^2) / scale^2 / (bits - 1))."""
    return sigmas * np.sqrt((1 - scale**2).clip(0) / scale**2 / max(bits - 1, 1))


def normed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of vectors as ``cosine`` takes them, and the vectors at length one."""
    norms = np.sqrt(ordered_sum(vectors * vectors))
    return norms, (vectors / norms[:, None]).astype(np.float32)


class Nearest:
    """The k nearest vectors to each query of a block, among the vectors met so far; ties go to the smaller id.

    A floor is a cosine that k vectors met reach. Vectors whose upper bound reaches it are reranked on the
    original vectors. The first floors are of the k vectors with the largest estimates among the first ones.
    """

    def __init__(self, ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int, sigmas: float):
        self.ids, self.exact, self.turn, self.k, self.sigmas = ids, balanced(queries), turn, k, sigmas
        self.norm, self.unit = normed(self.exact)
        self.floor, self.met = np.full(len(ids), -np.inf), 0
        #: Places of queries, ids of vectors and cosines.
        self.best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.slack = 1e-5 + 2.0**-23 * queries.shape[1]

    def meet(self, ids: np.ndarray, vectors: np.ndarray, packed: np.ndarray, scale: np.ndarray) -> None:
        exact = balanced(vectors)
        block = ids, exact, *normed(exact), decoded(packed, scale, self.turn), bounds(scale, self.turn.shape[1], self.sigmas)
        at = 0
        while at < len(ids):  # few at first, as floors are low
            to = at + max(FIRST_ROWS, 4 * self.k, self.met)
            part = [c[at:to] for c in block]
            self._keep(self._first(*part) if not self.met else self._reaching(*part))
            self.met += len(part[0])
            at = to

    def _first(self, ids, exact, norm, unit, stands, bound):
        found = []
        for low in range(0, len(self.ids), TILE_ROWS):
            some = slice(low, low + TILE_ROWS)
            about = self.unit[some] @ stands.T
            own = self.ids[some, None] == ids
            about[own] = -np.inf
            if len(ids) - own.sum(1).max() > self.k:
                likely = np.argpartition(about, -self.k, axis=1)[:, -self.k :]
                rows = np.repeat(np.arange(len(about)), self.k)
                self.floor[some] = cosine(self.exact[some][rows], exact[likely.ravel()]).reshape(-1, self.k).min(1)
                about[rows, likely.ravel()] = np.inf
            q, v = np.nonzero(about + bound.astype(np.float32) >= (self.floor[some] - self.slack).astype(np.float32)[:, None])
            found.append(self._reranked(q + low, v, ids, exact, norm, unit))
        return found

    def _reaching(self, ids, exact, norm, unit, stands, bound):
        found = []
        floor = (self.floor - self.slack).astype(np.float32)
        for low in range(0, len(self.ids), TILE_QUERIES):
            queries, least = self.unit[low : low + TILE_QUERIES].T, floor[low : low + TILE_QUERIES]
            about = np.empty((TILE_ROWS, len(least)), np.float32)
            reach = np.zeros((about.size + 7) // 8 * 8, bool)
            for at in range(0, len(ids), TILE_ROWS):
                tile = stands[at : at + TILE_ROWS]
                size = len(tile) * len(least)
                np.matmul(tile, queries, out=about[: len(tile)])
                np.greater_equal(about[: len(tile)], least - np.float32(bound[at : at + TILE_ROWS].max()), out=reach[:size].reshape(len(tile), -1))
                reach[size:] = False
                words = reach.view(np.uint64)
                eights = np.flatnonzero(words != 0)  # most are eight times no
                if len(eights):
                    one = np.flatnonzero(words[eights].view(bool))
                    pair = eights[one >> 3] * 8 + (one & 7)
                    v = pair // len(least)
                    found.append(self._reranked(pair - v * len(least) + low, v + at, ids, exact, norm, unit))
        return found

    def _reranked(self, q, v, ids, exact, norm, unit):
        """(query, id, cosine) of the pairs whose cosine reaches the floor; single precision spares most the exact one."""
        kept = []
        for at in range(0, len(q), 20_000):
            x, y = q[at : at + 20_000], v[at : at + 20_000]
            near = np.flatnonzero(np.einsum("ij,ij->i", self.unit.take(x, 0), unit.take(y, 0)) >= self.floor.take(x) - self.slack)
            x, y = x[near], y[near]
            score = ordered_sum(self.exact.take(x, 0) * exact.take(y, 0)) / (self.norm[x] * norm[y])
            near = (score >= self.floor[x]) & (self.ids[x] != ids[y])
            kept.append((x[near], ids[y[near]], score[near]))
        return [np.concatenate(c) for c in zip(*kept, strict=True)] if kept else [c[:0] for c in self.best]

    def _keep(self, found: list) -> None:
        if not found:
            return
        new = [np.concatenate(c) for c in zip(*found, strict=True)]
        changed = np.zeros(len(self.ids), bool)
        changed[new[0]] = True
        old = changed[self.best[0]]
        q, v, score = (np.concatenate([c[old], d]) for c, d in zip(self.best, new, strict=True))
        order = np.lexsort((v, -score, q))
        q, v, score = q[order], v[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        full = place == self.k - 1
        self.floor[q[full]] = score[full]
        keep = place < self.k
        self.best = tuple(np.concatenate([c[~old], d[keep]]) for c, d in zip(self.best, (q, v, score), strict=True))

    def rows(self) -> pa.RecordBatch:
        q, v, score = self.best
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (self.ids[q], v, score)], ["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, seed: int = 7, sigmas: float = 4.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query by cosine, itself left out.

    Both tables have (vec_id, embedding). Vectors that are null, empty, zero or hold null or
    non-finite components take no part, and neither do rows with a null vec_id; vectors only meet
    vectors of as many components; rows repeated under one vec_id are each candidates. Vectors are coded
    once and dealt out evenly, queries too, whatever their ids. A task takes a part of the vectors, as blocks,
    and a part of the queries from the shuffle, so neither table is copied on disk; it gives at most k rows for a
    query, and of all these the k best are taken. The index covers every row.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)  # a block is a row of megabytes
    good = [
        t.select(F.col("vec_id").cast("bigint"), _components(t).alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
        .withColumn("dim", F.size("embedding"))
        for t in (vectors, queries)
    ]
    counts = [{r.dim: r.n for r in t.groupBy("dim").agg(F.count("*").alias("n")).collect()} for t in good]  # a row per dimension
    dims = sorted(set(counts[0]) & set(counts[1]))
    found = [_search_dim(good, d, counts[0][d], counts[1][d], k, seed, sigmas) for d in dims]
    best = spark.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for part in found:
        best = best.union(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _components(t: DataFrame) -> Column:
    """The vectors as floats, where they are floats, and else as doubles."""
    kind = t.schema["embedding"].dataType
    kept = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col("embedding").cast("array<float>" if kept else "array<double>")


def _search_dim(good, dim: int, n: int, m: int, k: int, seed: int, sigmas: float) -> DataFrame:
    turn = rotation(dim, seed)
    kinds = [np.dtype("<f4" if "float" in t.schema["embedding"].dataType.simpleString() else "<f8") for t in good]
    width, query_width = (dim * kind.itemsize + -(-turn.shape[1] // 8) + 16 for kind in kinds)
    block_rows, part_rows = (min(rows, -(-size // width)) for rows, size in ((BLOCK_ROWS, BLOCK_BYTES), (PART_ROWS, PART_BYTES)))
    query_rows = min(QUERY_ROWS, -(-QUERY_BYTES // query_width))
    parts = -(-m // query_rows)
    tasks = 2 * good[0].sparkSession.sparkContext.defaultParallelism
    pieces = max(-(-n // part_rows), min(-(-n // block_rows), -(-tasks // parts)))
    names, row = ["vec_id", "x", "packed", "scale"], "vec_id bigint, x binary, packed binary, scale double"
    shape = pa.schema([(c, pa.binary()) for c in ("ids", "x", "packed", "scale")])

    def coded(table, kind, pieces):
        def code(batches):
            for batch in batches:
                x = matrix(batch.column(1)) if batch.num_rows else np.empty((0, dim))
                keep = np.isfinite(x).all(1) & (x != 0).any(1)
                x = x[keep]
                packed, scale = codes(balanced(x), turn)
                ids = batch.column(0).filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([ids, blobs(x.astype(kind)), blobs(packed), pa.array(scale)], names)

        dealt = table.filter(F.col("dim") == dim).select("vec_id", "embedding").mapInArrow(code, row)
        return dealt.repartition(pieces)

    def blocked(table, kind, most):
        def gather(batches):  # a block as one row
            held, size = [], 0
            for batch in batches:
                while batch.num_rows:
                    held.append(batch.slice(0, most - size))
                    size += held[-1].num_rows
                    batch = batch.slice(held[-1].num_rows)
                    if size == most:
                        yield block(held)
                        held, size = [], 0
            if held:
                yield block(held)

        def block(held):
            ids, scale = (b"".join(b.column(c).to_numpy().tobytes() for b in held) for c in (0, 3))
            x = b"".join(unblobbed(b.column(1), dim, kind).tobytes() for b in held)
            packed = b"".join(unblobbed(b.column(2), -(-turn.shape[1] // 8), np.uint8).tobytes() for b in held)
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (ids, x, packed, scale)], schema=shape)

        return table.mapInArrow(gather, "ids binary, x binary, packed binary, scale binary")

    data = blocked(coded(good[0], kinds[0], pieces), kinds[0], block_rows)
    asked = blocked(coded(good[1], kinds[1], parts), kinds[1], 2 * query_rows)
    asked = asked.select(F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), F.monotonically_increasing_id().alias("q"))
    met = asked.hint("shuffle_replicate_nl").crossJoin(data)  # each query block with the vector blocks, one after the other

    def run(batches):
        last = nearest = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                if row["q"].as_py() != last:
                    if nearest:
                        yield nearest.rows()
                    last = row["q"].as_py()
                    q_ids, q_x = (np.frombuffer(row[c].as_buffer(), kind) for c, kind in (("q_ids", "<i8"), ("q_x", kinds[1])))
                    nearest = Nearest(q_ids.copy(), q_x.reshape(-1, dim).astype(float), turn, k, sigmas)
                ids, x, packed, scale = (
                    np.frombuffer(row[c].as_buffer(), kind) for c, kind in (("ids", "<i8"), ("x", kinds[0]), ("packed", np.uint8), ("scale", "<f8"))
                )
                nearest.meet(ids, x.reshape(-1, dim).astype(float), packed.reshape(len(ids), -1), scale)
        if nearest:
            yield nearest.rows()

    return met.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
