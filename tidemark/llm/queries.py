"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann,
    binary,
    extract,
    laesa,
    language,
    packing,
    pieces,
    pq,
    secrets,
    simhash,
    suffixes,
    toxicity,
    whitening,
)
from tidemark.llm.common import table

WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    path = binary.new_folder(spark)
    binary.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), 2, path)
    read = binary.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op3_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label linked by a cosine of 0.93 or more."""
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op4_html_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op5_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by shortest paths and decoded again."""
    path = public_tokenizers.path(PIECES)
    rows = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == F.replace(F.col("text"), F.lit(pieces.MARK), F.lit(" "))).alias("round_trip"),
    )


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op6_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(_remainder(3) != 1))
    rows = docs.select("doc_id", "text", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"))
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(_remainder(4) != 2)
    model = toxicity.train(docs, labels)
    rows = docs.select("doc_id", "text", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"))
    scored = toxicity.predict(rows, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 400-byte strings that also start elsewhere."""
    return suffixes.removal_digest(table(spark, sf_dir, "documents"))


def op9_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by fingerprints that differ in three bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found, spans = secrets.scan(table(spark, sf_dir, "documents")), F.col("spans")
    return found.select(
        "doc_id",
        *[secrets.counted(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.listed(spans, secrets.BASE), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixteen leading components of every vector, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_pivot_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in eight codes of sixteen entries, after six rounds."""
    coded = laesa.compress(table(spark, sf_dir, "embeddings"), parts=8, size=16, rounds=6)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_rotated_codes": op2_rotated_codes,
    "op3_product_quantisation": op3_product_quantisation,
    "op4_html_field": op4_html_field,
    "op5_piece_transducer": op5_piece_transducer,
    "op6_language_kernel": op6_language_kernel,
    "op8_toxicity": op8_toxicity,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op9_simhash_bk_trees": op9_simhash_bk_trees,
    "op10_token_binary": op10_token_binary,
    "op11_secret_scan": op11_secret_scan,
    "op12_whitening": op12_whitening,
    "op13_pivot_codes": op13_pivot_codes,
}

#: Vectors that take part, with their norms, as rows of the SQL below.
_UNIT = """
    SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

_COSINE = "list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) / (a.norm * b.norm)"


def _pivot_codes_sql(parts: int = 8, size: int = 16, rounds: int = 6) -> str:
    """The rounds of op13 one after the other, each part against every entry."""
    distance = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))"
    steps = [
        """v AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(4096 * x)::BIGINT) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS MATERIALIZED (
            SELECT vec_id, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] AS x
            FROM v, range({parts}) t(part))""",
        f"""c0 AS MATERIALIZED (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY entry < {size})""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (
            SELECT p.vec_id, p.part, any_value(p.x) AS x, min({distance}::HUGEINT * {size} + c.entry) AS best
            FROM p JOIN c{n} c ON p.part = c.part GROUP BY p.vec_id, p.part)"""
        )
        if n < rounds:
            steps.append(
                f"""s{n} AS (
            SELECT part, best % {size} AS entry, i, sum(x[i])::HUGEINT AS total, count(*)::HUGEINT AS n
            FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{n}) GROUP BY ALL),
            f{n} AS (
            SELECT part, entry, list((((total - ((total % n + n) % n)) // n)::BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY ALL),
            c{n + 1} AS MATERIALIZED (
            SELECT c.part, c.entry, coalesce(f.x, c.x) AS x FROM c{n} c LEFT JOIN f{n} f ON c.part = f.part AND c.entry = f.entry)"""
            )
    steps.append(
        f"""e AS (
        SELECT vec_id, string_agg(printf('%02x', (best % {size})::INT), '' ORDER BY part) AS code,
               sum(best // {size})::BIGINT AS error FROM a{rounds} GROUP BY vec_id)"""
    )
    return f"""
        WITH {", ".join(steps)}
        SELECT e.vec_id, code, error, (sum(error) OVER (PARTITION BY v.label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
        FROM e JOIN v ON e.vec_id = v.vec_id"""


ORACLES: dict[str, str] = {
    "op13_pivot_codes": _pivot_codes_sql(),
    "op2_rotated_codes": f"""
        WITH v AS ({_UNIT}),
        s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, {_COSINE} AS score
              FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e))
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op3_product_quantisation": f"""
        WITH RECURSIVE v AS ({_UNIT} AND label IS NOT NULL),
        l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND {_COSINE} >= 0.93),
        r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
        n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id""",
}
