"""Best-fit packing of token pieces under several capacities at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches
from tidemark.llm.tokens import encoder

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, max_tokens: int = 2048, kind: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids) of documents (doc_id, text), end id included.

    Documents of more than ``max_tokens`` ids are cut into pieces of that size, the last one may be
    shorter. ``ids`` holds little-endian unsigned 32-bit integers. A null or empty text is the end id
    alone; null or repeated doc_ids are kept row by row; other columns are ignored, but for ``kind``, a text
    that the pieces of a document get too; no rows give none.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for keys, texts in text_batches(batches):
            out = [[], [], [], [], []]
            for key, ids in zip(keys, encoder(tokenizer).encode(texts), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    for column, value in zip(out, (key, k, at // 4, len(part) // 4, part), strict=True):
                        column.append(value)
            found = [pa.array(c, f.type) for c, f in zip(out, PIECE, strict=True)] if kind is None else _with_kind(out)
            yield pa.RecordBatch.from_arrays(found, schema=PIECE if kind is None else PIECE.append(pa.field(kind, pa.string())))

    key, schema = F.col("doc_id").cast("bigint"), "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    if kind is not None:
        key, schema = F.struct(key.alias("doc_id"), F.col(kind).cast("string").alias("kind")), f"{schema}, `{kind}` string"
    return docs.select(key, "text").mapInArrow(cut, schema)


def _with_kind(out: list[list]) -> list[pa.Array]:
    """Columns of pieces whose key is the doc_id and the kind."""
    keys, *others = out
    found = [pa.array(c, f.type) for c, f in zip([[k["doc_id"] for k in keys], *others], PIECE, strict=True)]
    return [*found, pa.array([k["kind"] for k in keys], pa.string())]


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str):
    """Bin and offset of each item, longest first.

    An item of n tokens asks for (n, 1, n * n) of the capacities (tokens, documents, attention cost).
    Among the open bins with room in all three it takes the one with the smallest weighted squared
    norm of what would be left over (``norm``), or the smallest weighted dot product of its demand
    and the bin's residual (``dot``); the earliest bin wins ties. If none has room a bin is opened.
    """
    demand = np.stack([lengths, np.ones_like(lengths), lengths * lengths], 1) / np.array(capacity, float)
    if len(demand) and demand.max() > 1:
        raise ValueError("an item exceeds the capacity of an empty bin")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room = np.empty((len(lengths), 3))  # of the open bins, one row each
    name, filled = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = demand.min(0) if len(demand) else 0
    w, slack, n, made = np.array(weights, float), 1e-12, 0, 0
    for i, need in enumerate(demand):
        at = -1
        if n:
            open_ = room[:n]
            fits = np.flatnonzero((open_ >= need - slack).all(1))
            if len(fits):
                left = open_[fits] - need
                score = (left * left) @ w if rule == "norm" else open_[fits] @ (w * need)
                at = fits[score.argmin()]
        if at < 0:
            at, n = n, n + 1
            room[at], name[at], filled[at] = 1.0, made, 0
            made += 1
        bins[i], offsets[i] = name[at], filled[at]
        room[at] -= need
        filled[at] += lengths[i]
        if (room[at] < least - slack).any():  # nothing fits any more
            n -= 1
            room[at:n], name[at:n], filled[at:n] = room[at + 1 : n + 1].copy(), name[at + 1 : n + 1].copy(), filled[at + 1 : n + 1].copy()
    return bins, offsets


def _runs(column: pa.ChunkedArray) -> list[slice]:
    """Where equal values of a sorted column lie; nulls are equal."""
    ends = pc.run_end_encode(column.combine_chunks()).run_ends.to_pylist() if len(column) else []
    return [slice(a, b) for a, b in zip([0, *ends], ends, strict=False)]


def pack(
    pieces: DataFrame,
    shards: int,
    max_tokens: int = 2048,
    max_documents: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02),
    rule: str = "norm",
    kind: str | None = None,
) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...).

    Pieces are dealt over ``shards`` by a hash of their key, so that copies and hot sources spread,
    and each shard is packed by :func:`best_fit`. A shard leaves about one sequence half empty, so
    shards of a few thousand pieces stay within a fraction of a per cent of one packing of all.
    Repeated rows are packed as rows of their own; no rows give none. Ids of any size keep their value beside nulls.
    With ``kind``, pieces that differ in that column share no sequence.
    """
    capacity = (max_tokens, max_documents or max_tokens, max_cost or max_tokens**2)

    shard = "_shard"
    while shard in pieces.columns:
        shard = f"_{shard}"

    def fill(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        longest = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        longest = longest if kind is None else [(kind, "ascending"), *longest]
        rows = rows.drop_columns(shard).take(pc.sort_indices(rows, sort_keys=longest))
        lengths = rows.column("length").to_numpy().astype(np.int64)
        bins, offsets, first = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
        for run in _runs(rows.column(kind)) if kind is not None else [slice(0, len(lengths))]:
            bins[run], offsets[run] = best_fit(lengths[run], capacity, weights, rule)
            bins[run] += first
            first = int(bins[run].max(initial=first - 1)) + 1
        rows = rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins))
        return rows.append_column("offset", pa.array(offsets))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.withColumn(shard, F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(shards)))
    return dealt.groupBy(shard).applyInArrow(fill, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, max_tokens: int = 2048, per_shard: int = 4096, kind: str | None = None) -> DataFrame:
    """Tokenise, cut and pack documents; the ids stay behind as their crc32.

    With ``kind``, a column of the documents, those of different kinds share no sequence, and pieces have the kind as well.

    Only the last piece of a document can be shorter than a sequence, so the shards hold about
    ``per_shard`` pieces to be fitted each, whatever the number of documents.
    """
    pieces = token_pieces(docs, tokenizer, end_id, max_tokens, kind)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *([] if kind is None else [kind]))
    return pack(pieces, max(1, -(-docs.count() // per_shard)), max_tokens, kind=kind)
