"""String functions with the semantics of the JVM's own string class."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The multiplier and word size of the 32-bit string hash, the multiplier and
# number of buckets of the visitor bit array.
HASH_MULTIPLIER = 31
HASH_WORD = 4294967296
BUCKET_MULTIPLIER = 61
BUCKETS = 256
#: Bytes of texts that are hashed together.
PIECE_BYTES = 1 << 20


def java_split(text: Column, pattern: str) -> Column:
    """Split on a regex, keeping leading and inner empty strings and dropping trailing ones.

    An empty text gives one empty string; a text of separators only gives an empty array.
    """
    return without_trailing_empty(F.split(text, pattern))


def without_trailing_empty(parts: Column) -> Column:
    """The second half of :func:`java_split`, for parts that are a column already.

    Used more than once here, so a split in a select of its own is computed only once.
    """
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when((F.size(parts) == 1) | (F.element_at(parts, -1) != ""), parts).otherwise(
        F.slice(parts, F.lit(1), F.coalesce(last, F.lit(0)))
    )


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units."""
    return F.floor(F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def _fold_units(text: Column, multiplier: int, modulus: int) -> Column:
    """``h = h * multiplier + unit`` over the UTF-16 units of a text, modulo ``modulus``."""

    def step(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        beyond = code - 65536
        high = F.shiftright(beyond, 10) + 55296
        low = beyond.bitwiseAND(F.lit(1023).cast("bigint")) + 56320
        one = h * multiplier + code
        two = (h * multiplier + high) * multiplier + low
        return F.pmod(F.when(code < 65536, one).otherwise(two), F.lit(modulus).cast("bigint"))

    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.aggregate(chars, F.lit(0).cast("bigint"), step)


def _wrap32(value: Column) -> Column:
    """A bigint as the signed 32-bit integer with the same low bits."""
    low = F.pmod(value, F.lit(HASH_WORD).cast("bigint"))
    return F.when(low >= HASH_WORD // 2, low - HASH_WORD).otherwise(low).cast("int")


def hash_code(text: Column, factor: int = 1) -> Column:
    """32-bit string hash times a factor, both wrapped to int. For ids and other short texts."""
    return _wrap32(_wrap32(_fold_units(text, HASH_MULTIPLIER, HASH_WORD)).cast("bigint") * factor)


def hash_code_of_texts(factor: int = 1):
    """:func:`hash_code` for long texts, as an Arrow function.

    Spark interprets a fold character by character; here texts are taken together up to ``PIECE_BYTES`` at a time and become
    one buffer of UTF-16 units, each unit is multiplied by the power of its distance from the end of its text, and the
    products are added text by text, in wrapping 32-bit arithmetic. A longer text is hashed piece by piece. So the memory
    is that of a piece beside a batch's own, whatever the texts.
    """

    @F.arrow_udf("int")
    def hashes(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string())
        found = np.zeros(len(texts), "u4")
        filled = pc.fill_null(texts, "")
        offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        start = 0
        while start < len(found):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, "right")) - 1)
            if offsets[stop] - offsets[start] > PIECE_BYTES:
                found[start] = _hash_by_pieces(filled[start].as_py())
            else:
                found[start:stop] = _hash_together(filled.slice(start, stop - start))[0]
            start = stop
        found = (found * np.uint32(factor % HASH_WORD)).astype("u4").view("i4")
        return pa.array(found, pa.int32(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return hashes


def _hash_by_pieces(text: str) -> int:
    """The hash of a long text: that of what came before moves up by the units of the next piece."""
    found, size = 0, PIECE_BYTES // 4
    for at in range(0, len(text), size):
        (piece,), (units,) = _hash_together(pa.array([text[at : at + size]], pa.large_string()))
        found = (found * pow(HASH_MULTIPLIER, int(units), HASH_WORD) + int(piece)) % HASH_WORD
    return found


def _hash_together(filled: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned hashes of texts, none of them null, and their numbers of UTF-16 units."""
    utf8 = _content(filled)
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    lead = np.frombuffer(utf8, np.uint8)
    # A byte that starts a character of four is two units, one that continues a character none.
    units_of = np.where(lead >= 0xF0, 2, np.where((lead & 0xC0) == 0x80, 0, 1))
    ends = np.append(0, np.cumsum(units_of))[offsets - offsets[0]]
    units = np.frombuffer(utf8.decode().encode("utf-16-le"), "<u2").astype("u4")
    sizes = np.diff(ends)
    powers = np.full(int(sizes.max(initial=0)) + 1, HASH_MULTIPLIER, "u4")
    powers[:1] = 1
    powers = np.multiply.accumulate(powers, dtype="u4")
    products = units * powers[np.repeat(ends[1:], sizes) - 1 - np.arange(len(units))]
    totals, some = np.zeros(len(sizes), "u4"), sizes > 0
    if some.any():
        totals[some] = np.add.reduceat(products, ends[:-1][some], dtype="u4")
    return totals, sizes


def _content(column: pa.Array) -> bytes:
    """The bytes of all texts of a column, one after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return column.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if column.buffers()[2] else b""


def visitor_bucket(visitor: Column) -> Column:
    """Bucket of a visitor in the bit array: the low bits of the hash of its decimal id."""
    return _fold_units(visitor.cast("string"), BUCKET_MULTIPLIER, BUCKETS).cast("int")


def register_hash_code(spark: SparkSession, name: str = "hash_code", factor: int = 1) -> None:
    """Make :func:`hash_code` callable from SQL, as a SQL function Catalyst inlines."""
    units = (
        "CASE WHEN ascii(c) < 65536 THEN h * {m} + ascii(c) ELSE "
        "(h * {m} + shiftright(ascii(c) - 65536, 10) + 55296) * {m} + ((ascii(c) - 65536) & 1023) + 56320 END"
    ).format(m=HASH_MULTIPLIER)
    fold = (
        "aggregate(CASE WHEN s = '' THEN CAST(array() AS array<string>) ELSE split(s, '') END, "
        f"0L, (h, c) -> pmod({units}, {HASH_WORD}L))"
    )
    half = HASH_WORD // 2
    once = f"pmod({fold} + {half}L, {HASH_WORD}L) - {half}L"
    body = f"CAST(pmod(({once}) * {factor} + {half}L, {HASH_WORD}L) - {half}L AS INT)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT RETURN {body}")
