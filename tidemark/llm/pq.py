"""Near-duplicate embeddings by product quantisation: inverted lists, table look-ups, exact rerank."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.components import components
from tidemark.llm.vectors import balanced, cosine, matrix, usable

TRAINING_ROWS, BLOCK_ROWS, CODES = 20_000, 2048, 64


def _k_means(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        for j in range(x.shape[1]):
            sums = np.bincount(near, x[:, j], len(centres))
            n = np.bincount(near, minlength=len(centres))
            centres[n > 0, j] = sums[n > 0] / n[n > 0]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)).clip(0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])


@dataclass
class Quantiser:
    """Coarse centres, and codebooks of the residual for each subspace."""

    centres: np.ndarray
    books: list[np.ndarray]

    @classmethod
    def fit(cls, unit: np.ndarray, lists: int, seed: int = 11) -> Quantiser:
        rng = np.random.default_rng(seed)
        centres = _k_means(unit, lists, rng)
        rest = unit - centres[_nearest(unit, centres)]
        cuts = range(0, unit.shape[1], 4)
        return cls(centres, [_k_means(rest[:, c : c + 4], CODES, rng) for c in cuts])

    def encode(self, unit: np.ndarray):
        """(cell, codes, error): error is the distance of a vector to what its code stands for."""
        cell = _nearest(unit, self.centres)
        rest = unit - self.centres[cell]
        code = np.stack([_nearest(rest[:, 4 * j : 4 * j + 4], b) for j, b in enumerate(self.books)], 1)
        stands = np.concatenate([b[code[:, j]] for j, b in enumerate(self.books)], 1)
        return cell, code.astype(np.uint8), np.linalg.norm(rest - stands, axis=1)

    def probes(self, unit: np.ndarray, radius: float):
        """(row, cell) of every cell that can hold a vector within ``radius`` of the row.

        A vector of another cell is on the other side of the bisector of its centre and the row's
        nearest one, so a cell can be left out if the row is farther than ``radius`` from that plane.
        """
        d = _distances(unit, self.centres)
        near = d.argmin(1)
        apart = np.sqrt(_distances(self.centres, self.centres))[near]
        with np.errstate(divide="ignore", invalid="ignore"):
            to_plane = (d - d[np.arange(len(d)), near][:, None]) / (2 * apart)
        return np.nonzero(~(to_plane > radius + 1e-6))  # the nearest itself is 0 / 0

    def within(self, query: np.ndarray, cell: int, code: np.ndarray, error: np.ndarray, radius: float):
        """(query, member) pairs that the table look-ups can't rule out, in blocks of queries.

        The look-up distance differs from the true one by at most the member's error.
        """
        limit = (radius + error + 1e-6) ** 2
        rest = query - self.centres[cell]
        for at in range(0, len(query), 512):
            part = rest[at : at + 512]
            total = np.zeros((len(part), len(code)), np.float32)
            for j, book in enumerate(self.books):
                total += _distances(part[:, 4 * j : 4 * j + 4], book).astype(np.float32)[:, code[:, j]]
            q, m = np.nonzero(total <= limit + 1e-4)
            yield q + at, m


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, key) of every row; key names its label and vector, null if it takes no part."""
    e = F.col("embedding")
    key = F.when(
        usable(e) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(),
        F.sha2(F.concat_ws("|", F.col("label").cast("string"), e.cast("string")), 256),
    )
    return vectors.select(F.col("vec_id").cast("bigint"), "label", "embedding", key.alias("key"))


def links(classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs a < b of nodes (node, label, embedding) of one label with cosine >= ``threshold``.

    The quantiser is fitted on at most ``TRAINING_ROWS`` rows, taken by a hash of the node; the index
    holds every row. Lists are kept in blocks of about ``BLOCK_ROWS`` rows, and so are the vectors that
    probe a list, so a list of a hot label is spread over many tasks.
    """
    spark = classes.sparkSession
    if classes.schema["label"].dataType.simpleString() not in ("int", "bigint", "string"):
        classes = classes.withColumn("label", F.col("label").cast("string"))
    sized = classes.withColumn("dim", F.size("embedding"))
    found = spark.createDataFrame([], "a bigint, b bigint")
    for dim, n in sorted((r.dim, r.n) for r in sized.groupBy("dim").agg(F.count("*").alias("n")).collect()):  # a row per dimension
        found = found.union(_links_dim(sized.filter(F.col("dim") == dim), dim, n, threshold))
    return found


def _links_dim(classes: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    spark = classes.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(TRAINING_ROWS).select("embedding").toArrow()
    x = balanced(matrix(sample.column("embedding").combine_chunks()))
    quantiser = Quantiser.fit(x / np.linalg.norm(x, axis=1)[:, None], max(1, int(np.sqrt(n) / 16)))

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, labels, x = batch.column(0), batch.column(1), balanced(matrix(batch.column(2)))
            unit = x / np.linalg.norm(x, axis=1)[:, None]
            cell, code, error = quantiser.encode(unit)
            q, p = quantiser.probes(unit, radius)
            row = np.concatenate([np.arange(len(x)), q])
            raw = x.astype("<f8").tobytes()
            size = 8 * dim
            vectors = [raw[i * size : (i + 1) * size] for i in range(len(x))]
            member = pa.array([c.tobytes() for c in code] + [None] * len(q), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    nodes.take(pa.array(row)),
                    labels.take(pa.array(row)),
                    pa.array(np.concatenate([cell, p]).astype(np.int32)),
                    member,
                    pa.array(np.concatenate([error, np.zeros(len(q))])),
                    pa.array([vectors[i] for i in row], pa.binary()),
                ],
                ["node", "label", "cell", "code", "error", "x"],
            )

    label = classes.schema["label"].dataType.simpleString()
    schema = f"node bigint, label {label}, cell int, code binary, error double, x binary"
    rows = staged(classes.select("node", "label", "embedding").mapInArrow(assign, schema), "list-rows")
    at = ["label", "cell"]
    sizes = rows.groupBy(*at).agg(
        F.ceil(F.count("code") / BLOCK_ROWS).cast("int").alias("lists"),
        F.ceil(F.count_if(F.col("code").isNull()) / BLOCK_ROWS).cast("int").alias("asks"),
    ).filter("lists > 0 AND asks > 0")
    sizes = sizes.toDF("label2", "cell2", "lists", "asks")
    rows = rows.join(sizes, (F.col("label") == F.col("label2")) & (F.col("cell") == F.col("cell2")))
    block = F.pmod(F.xxhash64("node"), F.when(F.col("code").isNull(), F.col("asks")).otherwise(F.col("lists"))).cast("int")
    rows = rows.select(*at, block.alias("block"), F.col("code").isNull().alias("asking"), "lists", "asks", "node", "code", "error", "x")

    def gather(t):
        first = {c: t.column(c)[0].as_py() for c in ("label", "cell", "block", "asking", "lists", "asks")}
        nodes = t.column("node").to_numpy().astype("<i8").tobytes()
        code = b"".join(c or b"" for c in t.column("code").to_pylist())
        error = t.column("error").to_numpy().astype("<f8").tobytes()
        x = b"".join(t.column("x").to_pylist())
        values = [*first.values(), nodes, code, error, x]
        return pa.table([pa.array([v], f.type) for v, f in zip(values, packed_schema, strict=True)], schema=packed_schema)

    kinds = {f.name: f.dataType for f in rows.schema}
    label_type = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kinds["label"].simpleString()]
    packed_schema = pa.schema(
        [("label", label_type), ("cell", pa.int32()), ("block", pa.int32()), ("asking", pa.bool_()), ("lists", pa.int32()), ("asks", pa.int32())]
        + [(c, pa.binary()) for c in ("nodes", "codes", "errors", "vectors")]
    )
    made = f"label {label}, cell int, block int, asking boolean, lists int, asks int, nodes binary, codes binary, errors binary, vectors binary"
    blocks = staged(rows.groupBy(*at, "block", "asking").applyInArrow(gather, made), "list-blocks")
    held = blocks.filter("NOT asking").withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
    asking = blocks.filter("asking").select(
        F.col("label").alias("label2"), F.col("cell").alias("cell2"), F.col("block").alias("ask2"), F.col("nodes").alias("q_nodes"), F.col("vectors").alias("q_x")
    )
    met = held.join(asking, (F.col("label") == F.col("label2")) & (F.col("cell") == F.col("cell2")) & (F.col("ask") == F.col("ask2")))

    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                nodes, asked = np.frombuffer(row["nodes"], "<i8"), np.frombuffer(row["q_nodes"], "<i8")
                x, q_x = (np.frombuffer(row[c], "<f8").reshape(-1, dim) for c in ("vectors", "q_x"))
                code = np.frombuffer(row["codes"], np.uint8).reshape(len(nodes), -1)
                unit = q_x / np.linalg.norm(q_x, axis=1)[:, None]
                for q, m in quantiser.within(unit, row["cell"], code, np.frombuffer(row["errors"], "<f8"), radius):
                    once = asked[q] < nodes[m]
                    q, m = q[once], m[once]
                    close = cosine(q_x[q], x[m]) >= threshold
                    yield pa.RecordBatch.from_arrays([pa.array(asked[q[close]]), pa.array(nodes[m[close]])], ["a", "b"])

    needed = met.select("cell", "nodes", "codes", "errors", "vectors", "q_nodes", "q_x")
    return needed.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, label).

    Vectors of one label link if their cosine reaches ``threshold``. Equal vectors of a label are one
    node while links are sought and count as links of each other. Rows with a null label, or a vector
    that is null, empty, zero or holds null or non-finite components, have no link and are their own
    component; vectors only meet vectors of as many components; a null vec_id stays null and is not
    kept. A repeated vec_id gives a row each, and its vectors are one node, so their links are shared.
    """
    rows = vector_classes(vectors)
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    classes = staged(classes, "vector-classes")
    found = staged(links(classes.select("node", "label", "embedding"), threshold).distinct(), "vector-links")
    both = found.union(found.select("b", "a")).toDF("node2", "other")
    sizes = classes.select(F.col("node").alias("other2"), "n")
    more = both.join(sizes, F.col("other") == F.col("other2")).groupBy("node2").agg(F.sum("n").alias("more"))
    reach = components(found).toDF("node3", "component")
    known = (
        classes.select("key", "node", "n")
        .join(more, F.col("node") == F.col("node2"), "left")
        .join(reach, F.col("node") == F.col("node3"), "left")
        .select(
            F.col("key").alias("key2"),
            (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    known = staged(known, "vector-components")
    joined = rows.select("vec_id", "key").join(known, F.col("key") == F.col("key2"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
