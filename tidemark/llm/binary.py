"""Token ids as compressed binary tables: static range asymmetric numeral systems over blocks."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import shared_folder, staged, text_batches
from tidemark.llm.tokens import encoder, vocabulary_size

SCALE = 20  # bits of the frequency scale: room for any vocabulary of public tokenizers
LOW = np.uint64(1 << 31)
BLOCK_TOKENS, LANES, CHECKPOINT_STEPS = 1 << 18, 2048, 32

RAW = (
    "file_id int, block int, first bigint, n_tokens bigint, cut_first bigint, "
    "doc_ids array<bigint>, doc_lengths array<bigint>, ids binary"
)
CODED = (
    "block int, first bigint, n_tokens bigint, cut_first bigint, doc_ids array<bigint>, doc_lengths array<bigint>, "
    "lanes int, mark_steps int, marks array<struct<word:bigint,docs:int,start:bigint,crc:bigint>>, states binary, "
    "words binary, ids_crc32 bigint, file_id int"
)


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least one for each id that occurs."""
    counts, total = counts.astype(np.float64), float(counts.sum())
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts / max(total, 1) * (1 << SCALE))), 0).astype(np.int64)
    spare = (1 << SCALE) - int(freq.sum())
    if spare > 0:
        freq[int(freq.argmax())] += spare
    while spare < 0:  # give back from the largest, one half at a time at most
        at = int(freq.argmax())
        take = min(-spare, int(freq[at]) // 2)
        freq[at] -= take
        spare += take
    return freq


class Coder:
    """Encodes and decodes blocks of ids with one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        """The id at each slot of the frequency scale; only decoding needs it."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def encode(self, ids: np.ndarray, lanes: int, every: int = CHECKPOINT_STEPS):
        """(states, words, marks, mark states): id i of the block belongs to lane i % lanes.

        Words are 32-bit, in the order in which decoding reads them. A mark is the place in ``words``
        before each ``every``-th step but the first, with the lanes' states at that step.
        """
        steps = -(-len(ids) // lanes)
        freq, start = self.freq[ids], self.start[ids]
        x = np.full(lanes, LOW, np.uint64)
        words, sizes, kept = [], np.zeros(steps, np.int64), []
        bits, shift = np.uint64(SCALE), np.uint64(63 - SCALE)
        for t in range(steps - 1, -1, -1):
            f, c = freq[t * lanes : (t + 1) * lanes], start[t * lanes : (t + 1) * lanes]
            y = x[: len(f)]  # a view; the last step may be short
            over = y >= (f << shift)
            if over.any():
                out = y[over]
                words.append(out.astype(np.uint32))
                sizes[t] = len(out)
                y[over] = out >> np.uint64(32)
            q = y // f
            y[:] = (q << bits) + (y - q * f) + c
            if t and t % every == 0:
                kept.append(x.copy())
        words = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
        before = np.cumsum(sizes) - sizes
        marks = before[every::every]
        return x, words, marks, np.array(kept[::-1], np.uint64).reshape(-1, lanes)

    def decode(self, n: int, lanes: int, states: np.ndarray, words: np.ndarray, step: int = 0, at: int = 0) -> np.ndarray:
        """The ids from step ``step`` to the end of a block of ``n``; ``at`` and ``states`` as they are there."""
        out = np.empty(n - step * lanes, np.uint32)
        x, symbol = states.astype(np.uint64).copy(), self.symbol
        mask, bits = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
        for k in range(0, len(out), lanes):
            y = x[: min(lanes, len(out) - k)]
            slot = y & mask
            s = symbol[slot]
            out[k : k + len(y)] = s
            y[:] = self.freq[s] * (y >> bits) + slot - self.start[s]
            low = y < LOW
            m = int(np.count_nonzero(low))
            if m:
                y[low] = (y[low] << np.uint64(32)) | words[at : at + m].astype(np.uint64)
                at += m
        return out


def raw_blocks(docs: DataFrame, tokenizer: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole documents, in ascending doc_id within and across file_ids (null ids first).

    Rows with the same doc_id are kept, in order of a hash of their texts, then of the texts. The ranges are of ids and
    hashes: what Spark samples to find them holds no texts. ``first`` counts the ids of the same
    file before the block. A document longer than a block is cut into blocks that hold nothing else;
    their ``cut_first`` counts the ids of the file before the document, and is null for whole documents.
    """
    narrow = np.dtype("<u2") if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else np.dtype("<u4")
    end = np.array([end_id], "<u4").tobytes()
    sort = ["doc_id", "hash"]
    ordered = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("hash"))
    ordered = ordered.repartitionByRange(*sort).sortWithinPartitions(*sort, "text")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("file_id"))
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["file_id", "block", "first", "n_tokens", "cut_first", "doc_ids", "doc_lengths", "ids"]

    def blocks(batches):
        file_id, block, first, keys, parts, size = None, 0, 0, [], [], 0

        def row(cut_first=None):
            nonlocal block, first, keys, parts, size
            n = size // 4
            ids = np.frombuffer(b"".join(parts), "<u4").astype(narrow).tobytes()
            values = [file_id, block, first, n, cut_first, keys, [len(p) // 4 for p in parts], ids]
            block, first, keys, parts, size = block + 1, first + n, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        def seen():
            nonlocal file_id
            for batch in batches:
                if batch.num_rows:
                    file_id = batch.column(2)[0].as_py()
                    yield batch

        for some, texts in text_batches(seen()):
            for key, ids in zip(some, encoder(tokenizer).encode(texts), strict=True):
                ids += end
                if parts and size + len(ids) > 4 * block_tokens:
                    yield row()
                if len(ids) > 4 * block_tokens:
                    document = first
                    for at in range(0, len(ids), 4 * block_tokens):
                        keys, parts = [key], [ids[at : at + 4 * block_tokens]]
                        size = len(parts[0])
                        yield row(document)
                    continue
                keys.append(key)
                parts.append(ids)
                size += len(ids)
        if parts:
            yield row()

    return ordered.mapInArrow(blocks, RAW)


def lanes_of(n: int) -> int:
    """Lanes of a block of ``n`` ids: a power of two with 64 steps or more, 16 at least."""
    return min(LANES, max(16, 1 << (n // 64).bit_length() >> 1))


def _unpack(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def token_counts(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of each id over all blocks: summed in the tasks, then by id."""

    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total += np.bincount(_unpack(ids.as_buffer(), n), minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    sums = blocks.select("n_tokens", "ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = np.zeros(vocabulary, np.int64)
    for row in sums.toLocalIterator():  # at most one row per id of the vocabulary
        found[row.id] = row.n
    return found


def _marks(coder: Coder, values: np.ndarray, lengths: np.ndarray, lanes: int, every: int):
    """(marks, states, words, crc32 of all ids) of a block.

    A mark stands before each ``every``-th step, the first too: the words before it, the documents that start
    before it, the place of the first document that starts at or after it, and the crc32 of all ids before that place.
    """
    first, words, places, later = coder.encode(values, lanes, every)
    ends = np.cumsum(lengths)
    starts = np.append(ends - lengths, len(values))
    docs = np.searchsorted(starts[:-1], every * lanes * np.arange(len(places) + 1))
    marks, crc, at, data = [], 0, 0, values.astype("<u4")
    for place, n in zip([0, *places.tolist()], docs.tolist(), strict=True):
        start = int(starts[n])
        crc, at = zlib.crc32(data[at:start].tobytes(), crc), start
        marks.append({"word": place, "docs": n, "start": start, "crc": crc})
    states = first.tobytes() + later.tobytes()
    return marks, states, words.tobytes(), zlib.crc32(data[at:].tobytes(), crc)


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, path: str, block_tokens: int = BLOCK_TOKENS, every: int = CHECKPOINT_STEPS
) -> None:
    """Encode documents into the folder ``path``.

    ``path/frequencies`` holds the shared table, ``path/blocks`` one row per block, in a folder per
    file: documents and lengths, lanes, words, and a mark with the lanes' states before every ``every``-th
    step, from which decoding can start; checksums are of ids as little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    vocabulary = max(vocabulary_size(tokenizer), end_id + 1)
    blocks = staged(raw_blocks(docs, tokenizer, end_id, block_tokens), "token-blocks")
    freq = scaled_frequencies(token_counts(blocks, vocabulary))
    table = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(table, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/frequencies")
    names = [c.name for c in T.StructType.fromDDL(CODED)]

    def code(batches):
        coder = Coder(freq)
        for batch in batches:
            for row in range(batch.num_rows):
                file_id, block, first, n, cut_first, keys, lengths, ids = (c[row] for c in batch.columns)
                values = _unpack(ids.as_buffer(), n.as_py()).astype(np.uint32)
                lanes = lanes_of(len(values))
                marks, states, words, crc = _marks(coder, values, np.array(lengths.as_py(), np.int64), lanes, every)
                out = [block, first, n, cut_first, keys, lengths, lanes, every, marks, states, words, crc, file_id]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.as_py() if isinstance(v, pa.Scalar) else v], k) for v, k in zip(out, CODED_TYPES, strict=True)],
                    names,
                )

    blocks.mapInArrow(code, CODED).write.partitionBy("file_id").parquet(f"{path}/blocks")


_MARK = pa.struct([("word", pa.int64()), ("docs", pa.int32()), ("start", pa.int64()), ("crc", pa.int64())])
CODED_TYPES = [
    pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32(),
    pa.list_(_MARK), pa.binary(), pa.binary(), pa.int64(), pa.int32(),
]


def pieces(blocks: DataFrame) -> DataFrame:
    """A row for each mark after which documents start: all that decoding these documents takes, and no more.

    ``skip`` ids before the first of them end a document of an earlier piece. The words reach to the first mark at
    or after the end of the last document, so a piece runs on into the next one where a document does.
    """

    def piece(mark, k):
        after = F.get("marks", k + 1)
        until = F.coalesce(after["start"], "n_tokens")
        docs = F.coalesce(after["docs"], F.size("doc_ids")) - mark["docs"]
        span = F.col("lanes").cast("bigint") * F.col("mark_steps")
        stop = F.coalesce(F.get("marks", F.ceil(until / span).cast("int"))["word"], F.octet_length("words") / 4)
        return F.struct(
            docs.alias("docs"),
            (k * span).alias("place"),
            (mark["start"] - k * span).alias("skip"),
            until.alias("until"),
            F.slice("doc_ids", mark["docs"] + 1, docs).alias("doc_ids"),
            F.slice("doc_lengths", mark["docs"] + 1, docs).alias("doc_lengths"),
            F.substring("states", (k * F.col("lanes") * 8 + 1).cast("int"), F.col("lanes") * 8).alias("states"),
            F.substring("words", (mark["word"] * 4 + 1).cast("int"), ((stop - mark["word"]) * 4).cast("int")).alias("words"),
            mark["crc"].alias("crc_before"),
            F.coalesce(after["crc"], "ids_crc32").alias("crc_after"),
        )

    found = blocks.select("file_id", "first", "cut_first", "lanes", F.inline(F.transform("marks", piece)))
    return found.filter(F.col("docs") > 0).drop("docs")


def read_tokens(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the folder, decoded piece by piece from the marks.

    ``start`` is the number of ids of all documents before it, ``ids`` little-endian unsigned 32-bit
    integers. A piece whose ids do not match its checksum raises ``ValueError``. With ``tasks`` the pieces are dealt
    out over so many tasks, so a few large blocks are decoded side by side; else a file's tasks decode its pieces.
    """
    table = spark.read.parquet(f"{path}/frequencies").collect()  # one row per id of the vocabulary
    freq = np.zeros(max([r.id for r in table], default=-1) + 1, np.int64)
    for r in table:
        freq[r.id] = r.frequency
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    totals = blocks.groupBy("file_id").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n"))
    before, at = {}, 0
    for r in sorted(totals.collect()):  # a row per file, of which there are as many as partitions
        before[r.file_id], at = at, at + r.n

    def decode(batches):
        coder = Coder(freq)
        for batch in batches:
            for row in range(batch.num_rows):
                file_id, first, cut_first, lanes, place, skip, until, keys, lengths, states, words, old, crc = (c[row] for c in batch.columns)
                n, at = lanes.as_py(), before[file_id.as_py()]
                got = coder.decode(
                    until.as_py() - place.as_py(), n, np.frombuffer(states.as_buffer(), "<u8"), np.frombuffer(words.as_buffer(), "<u4")
                )[skip.as_py() :].astype("<u4").tobytes()
                if zlib.crc32(got, old.as_py()) != crc.as_py():
                    raise ValueError(f"checksum of a block of file {file_id.as_py()} does not match")
                sizes = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                document = None if cut_first.as_py() is None else cut_first.as_py() + at
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.as_py(), pa.int64()),
                        pa.array(starts + (first.as_py() + place.as_py() + skip.as_py() + at)),
                        pa.array(sizes),
                        pa.array([got[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                        pa.array([document] * len(sizes), pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids", "document"],
                )

    def decoded(some: DataFrame) -> DataFrame:
        dealt = pieces(some) if tasks is None else pieces(some).repartition(tasks)
        return dealt.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary, document bigint")

    whole = decoded(blocks.filter(F.col("cut_first").isNull())).drop("document")
    cut = decoded(blocks.filter(F.col("cut_first").isNotNull())).groupBy("document")
    joined = cut.agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.expr("listagg(ids) WITHIN GROUP (ORDER BY start)").alias("ids")
    )
    return whole.unionByName(joined.withColumnRenamed("document", "start"))


def new_folder(spark: SparkSession) -> str:
    """A new folder for token files in the shared folder."""
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
