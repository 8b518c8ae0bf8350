"""Repeated byte strings of a whole corpus: sampled suffixes are sorted and named first, the remaining
suffixes only where the names leave a question open.

A window is a string of ``length`` bytes. Each window is named by a sample position inside it, the
place of its smallest gram hash, which equal windows share. Consecutive windows of one sample form a
block. Sorting and counting blocks by the text after the sample, then by their whole text, settles all
windows but those at the ends of repeats; those are merged in by their distance to the sample, in
cells of ``CELL`` distances first and then one by one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import merged, staged

LENGTH, GRAM, CELL = 400, 16, 16
PART = 1 << 23  # windows handled at a time
MARKS = 1 << 24  # bits of the map of texts that are looked up


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each position."""
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()  # the eight bytes from each position
    h = word[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ (word[8:] + np.uint64(0x51ED270B)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def span_of(length: int) -> int:
    """The grams at the start of a window among which its sample is chosen."""
    return length * 4 // 5


def sample_places(data: bytes, length: int = LENGTH) -> np.ndarray:
    """For each window of ``length`` bytes, the first place of the smallest hash of its first grams."""
    span = span_of(length)
    h = gram_hashes(data)
    places = np.arange(len(h), dtype=np.uint64)
    h = h >> np.uint64(24) << np.uint64(24) | places  # the place breaks ties
    n = len(data) - length + 1
    h = h[: n + span - 1]
    rows = np.concatenate([h, np.full(-len(h) % span, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
    ahead = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, 1).ravel()
    return (np.minimum(ahead[:n], behind[span - 1 : span - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


def blocks_of(data: bytes, length: int = LENGTH):
    """(first window, last window, sample place) of the blocks of a text."""
    found = []
    for base in range(0, len(data) - length + 1, PART):
        place = sample_places(data[base : base + PART + length - 1], length)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        found.append(np.stack([first, last, place[first]], 1) + base)
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _wide(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def text_key(text: Column) -> Column:
    """Names a text; equal texts share all their results."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _block_rows(texts: DataFrame, length: int) -> DataFrame:
    names = ["f", "b1", "b2", "t", "lo", "hi", "m"]
    after = length - span_of(length) + 1  # bytes that every window of a block has after its sample place

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py().encode("utf-8", "surrogatepass")
                rows = blocks_of(data, length)
                for at in range(0, len(rows), 100_000):
                    some = rows[at : at + 100_000]
                    triples = some.tolist()
                    f = np.array([xxhash.xxh3_64_intdigest(data[m : m + after]) for _, _, m in triples], np.uint64)
                    b = _wide([xxhash.xxh3_128_digest(data[lo : hi + length]) for lo, hi, _ in triples])
                    columns = [f.view(np.int64), b[:, 0], b[:, 1], pa.array([key.as_py()] * len(some), pa.binary()), *some.T]
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c)) for c in columns], names)

    long = texts.filter(F.octet_length("text") >= length)
    return long.select("t", "text").mapInArrow(lambda batches: merged(run(batches)), "f bigint, b1 bigint, b2 bigint, t binary, lo bigint, hi bigint, m bigint")


def _per_text(rows: DataFrame, name: str) -> DataFrame:
    """One row per text with the set of its (lo, hi, m, n); a text has no more of them than bytes."""
    return rows.groupBy(F.col("t").alias("t2")).agg(F.collect_set(F.struct("lo", "hi", "m", "n")).alias(name))


def _on_texts(texts: DataFrame, items: DataFrame, run, schema: str, length: int) -> DataFrame:
    """``run(data, items, length)`` of every text that has items; it yields record batches without the key."""

    def each(batches):
        for batch in batches:
            for key, text, some in zip(*(batch.column(i) for i in range(3)), strict=True):
                rows = [(r["lo"], r["hi"], r["m"], r["n"]) for r in some.as_py()]
                for columns in run(text.as_py().encode("utf-8", "surrogatepass"), rows, length):
                    own = pa.array([key.as_py()] * len(columns[0]), pa.binary())
                    yield pa.RecordBatch.from_arrays([own, *(pa.array(c) for c in columns)], names)

    names = [c.split()[0] for c in schema.split(", ")]
    met = texts.select("t", "text").join(_per_text(items, "items"), F.col("t") == F.col("t2")).select("t", "text", "items")
    return met.mapInArrow(lambda batches: merged(each(batches)), schema)


def _cells(data: bytes, items: list[tuple], length: int):
    """Per block and cell of distances to the sample: a hash of what all its windows share, one of all they span."""
    shared, spanned, lows, highs, n = [], [], [], [], []
    for lo, hi, m, times in items:
        for cell in range((m - hi) // CELL, (m - lo) // CELL + 1):
            first, last = max(lo, m - cell * CELL - CELL + 1), min(hi, m - cell * CELL)
            core = data[m - cell * CELL : m - cell * CELL + length - CELL + 1]
            shared.append(xxhash.xxh3_64_intdigest(core, cell))
            spanned.append(xxhash.xxh3_128_digest(data[first : last + length], cell))
            lows.append(first)
            highs.append(last)
            n.append(times)
    if n:
        s = _wide(spanned)
        yield np.array(shared, np.uint64).view(np.int64), np.ascontiguousarray(s[:, 0]), np.ascontiguousarray(s[:, 1]), lows, highs, n


def _windows(data: bytes, items: list[tuple], length: int):
    places = [(s, n) for lo, hi, _, n in items for s in range(lo, hi + 1)]
    for at in range(0, len(places), 100_000):
        some = places[at : at + 100_000]
        w = _wide([xxhash.xxh3_128_digest(data[s : s + length]) for s, _ in some])
        yield np.ascontiguousarray(w[:, 0]), np.ascontiguousarray(w[:, 1]), [s for s, _ in some], [n for _, n in some]


def _same(key: list[str], other: DataFrame) -> Column:
    on = F.col(key[0]) == other[f"{key[0]}_"]
    for k in key[1:]:
        on = on & (F.col(k) == other[f"{k}_"])
    return on


def _totals(rows: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """Keys that stand for two or more places, with whether all their rows agree in ``names``."""
    agree = [F.min(c) == F.max(c) for c in names]
    alike = F.lit(True)
    for a in agree:
        alike = alike & a
    found = rows.groupBy(*key).agg(F.sum("n").alias("total"), alike.alias("alike")).filter("total > 1")
    # Written, so that the join that follows shuffles both sides itself and can split a hot key.
    return staged(found.select(*[F.col(k).alias(f"{k}_") for k in key], "alike"), "totals")


def _marked(rows: DataFrame, keys: DataFrame, key: Column, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: false only if ``key`` is not in the first column of ``keys``.

    One bit of a map of ``MARKS`` bits, which is all that is broadcast, stands for a key. So most texts that are not looked
    up stay where they are, and only the others are shuffled.
    """
    bit = F.pmod(F.xxhash64(keys.columns[0]), F.lit(MARKS))
    places = keys.select(F.bitmap_bucket_number(bit).alias(f"{name}_bucket2"), F.bitmap_bit_position(bit).alias("at"))
    bits = places.groupBy(f"{name}_bucket2").agg(F.bitmap_construct_agg("at").alias(f"{name}_bits"))
    own = F.pmod(F.xxhash64(key), F.lit(MARKS))
    met = rows.withColumn(f"{name}_bucket", F.bitmap_bucket_number(own)).withColumn(f"{name}_at", F.bitmap_bit_position(own))
    met = met.join(F.broadcast(bits), F.col(f"{name}_bucket") == F.col(f"{name}_bucket2"), "left")
    byte = F.conv(F.hex(F.substring(F.col(f"{name}_bits"), F.floor(F.col(f"{name}_at") / 8) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.bit_get(byte, F.pmod(F.col(f"{name}_at"), F.lit(8)).cast("int")) == 1
    return met.withColumn(name, F.coalesce(is_set, F.lit(False))).select(*rows.columns, name)


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts, covered): the texts with repeats (t, text), and (t, lo, hi) runs of windows that occur elsewhere."""
    texts = docs.select(text_key(F.col("text")).alias("t"), "text")
    blocks = staged(_block_rows(texts, length).withColumn("n", F.lit(1).cast("bigint")), "blocks")
    twice = _totals(blocks, ["f"], ["b1", "b2"])
    near = staged(blocks.join(twice, _same(["f"], twice)).drop("f_"), "blocks-met")
    mixed = near.filter("NOT alike")
    kinds = staged(
        mixed.groupBy("f", "b1", "b2").agg(F.sum("n").alias("n"), F.min(F.struct("t", "lo", "hi", "m")).alias("at")), "block-kinds"
    )
    again = kinds.filter("n > 1").select(F.col("b1").alias("b1_"), F.col("b2").alias("b2_"))
    known = near.filter("alike").select("t", "lo", "hi").union(mixed.join(again, _same(["b1", "b2"], again)).select("t", "lo", "hi"))
    known = staged(known.distinct(), "blocks-covered")
    open_ = kinds.select("at.t", "at.lo", "at.hi", "at.m", "n")
    touched = staged(known.select("t").union(open_.select("t")).distinct().withColumnRenamed("t", "t2"), "repeating-keys")
    near = _marked(texts, touched, F.col("t"), "marked").filter("marked").select("t", "text")
    held = staged(near.dropDuplicates(["t"]).join(touched, F.col("t") == F.col("t2")).select("t", "text"), "repeating-texts")
    cells = staged(_on_texts(held, open_, _cells, "t binary, p bigint, u1 bigint, u2 bigint, lo bigint, hi bigint, n bigint", length), "cells")
    met = _totals(cells, ["p"], ["u1", "u2"])
    met = staged(cells.join(met, _same(["p"], met)).select("t", "lo", "hi", "n", "alike"), "cells-met")
    rest = met.filter("NOT alike").select("t", "lo", "hi", F.lit(0).cast("bigint").alias("m"), "n")
    single = staged(_on_texts(held, rest, _windows, "t binary, w1 bigint, w2 bigint, s bigint, n bigint", length), "windows")
    pairs = _totals(single, ["w1", "w2"], [])
    one = single.join(pairs, _same(["w1", "w2"], pairs)).select("t", F.col("s").alias("lo"), F.col("s").alias("hi"))
    return held, known.union(met.filter("alike").select("t", "lo", "hi")).union(one)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(t, spans, kept, kept_text) of each distinct text that holds a repeated window.

    ``t`` is :func:`text_key` of the text, ``spans`` the maximal runs of bytes [start, stop) covered by
    windows that also start anywhere else, in this document or another, ``kept`` the bytes left, and
    ``kept_text`` the same without the characters of which a byte was removed.
    Null text counts as empty; texts shorter than a window have no row; copies of a text, repeated
    rows included, share one row; no documents give no rows. Only the text column is read.
    """
    held, covered = repeated_windows(docs, length)
    covered = covered.withColumn("m", F.lit(0).cast("bigint")).withColumn("n", F.lit(1).cast("bigint"))

    def cut(data, rows, length):
        edges = np.array([(lo, hi + length) for lo, hi, _, _ in rows], np.int64)
        edges = edges[edges[:, 0].argsort(kind="stable")]
        reach = np.maximum.accumulate(edges[:, 1])
        new = np.concatenate([[True], edges[1:, 0] > reach[:-1]])
        starts = edges[new, 0].tolist()
        stops = reach[np.concatenate([np.flatnonzero(new)[1:], [len(edges)]]) - 1].tolist()
        left = [data[a:b] for a, b in zip([0, *stops], [*starts, len(data)], strict=True)]
        text = "".join([x.decode("utf-8", "ignore") for x in left])
        yield [[{"start": a, "stop": b} for a, b in zip(starts, stops, strict=True)]], [b"".join(left)], [text]

    return _on_texts(held, covered, cut, "t binary, spans array<struct<start:bigint,stop:bigint>>, kept binary, kept_text string", length)


def cut_repeats(docs: DataFrame, name: str = "cut", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs``, with ``name`` (spans, kept, kept_text) added, null where nothing was removed.

    A column of that name is replaced; others are kept, whatever their names.
    """
    docs = docs.drop(name)
    found = staged(repeated_spans(docs, length), "repeats")
    key, mark = f"_key_of_{name}", f"_mark_of_{name}"
    found = found.select(F.col("t").alias(key), F.struct("spans", "kept", "kept_text").alias(name))
    marked = _marked(docs, found.select(key), text_key(F.col("text")), mark)
    cut = marked.filter(F.col(mark)).join(found, text_key(F.col("text")) == F.col(key), "left").drop(key, mark)
    whole = marked.filter(~F.col(mark)).drop(mark).withColumn(name, F.lit(None).cast(found.schema[name].dataType))
    return cut.unionByName(whole)


def removal_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document; texts stay where they are."""
    found = staged(repeated_spans(docs), "repeats")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["stop"] - x["start"])
    found = found.select(
        F.col("t").alias("t2"), removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("sha")
    )
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", text_key(F.col("text")).alias("t"), F.octet_length(data).cast("bigint").alias("n_bytes"), F.sha2(data, 256).alias("own")
    )
    return rows.join(found, F.col("t") == F.col("t2"), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("sha", "own").alias("kept_sha256"),
    )


def spans_by_brute_force(texts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """The same spans from a table of all windows; for tests."""
    count: dict[bytes, int] = {}
    for data in texts:
        for s in range(len(data) - length + 1):
            w = hashlib.md5(data[s : s + length]).digest()
            count[w] = count.get(w, 0) + 1
    out = []
    for data in texts:
        spans: list[list[int]] = []
        for s in range(len(data) - length + 1):
            if count[hashlib.md5(data[s : s + length]).digest()] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + length
                else:
                    spans.append([s, s + length])
        out.append([tuple(x) for x in spans])
    return out
