"""The pipeline and the registered queries on the small tables."""

import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests_help import same

from tidemark.llm import language, queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    rows = queries.QUERIES[name](spark, sf).collect()
    assert rows
    if name in queries.ORACLES:
        assert same(duckdb.connect(), sf, queries.ORACLES[name], rows)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    names = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in rows} <= names and len({r.doc_id for r in rows}) > len(names) // 2
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048


def test_each_stage_takes_odd_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "the old house and the river " * 40, "en", "a", 5), (3, "the day " * 90, "en", "b", 6)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(spark, df, sf)
            assert name == "best_fit_packing" or out.columns == odd.columns
            out.collect()


def test_each_stage_takes_clashing_names(spark, sf):
    """Names the stages use themselves are the caller's columns, and come back as they were."""
    clashing = ["lang2", "score", "component_id", "kept_text", "_shard", "fp", "cut", "spans", "lang_pred", "t", "place"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    odd = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clashing)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, sf)
        rows = out.collect()
        if name != "best_fit_packing":
            assert out.columns == odd.columns
            assert all(r[c] == i for r in rows for i, c in enumerate(clashing))


def test_language_stage_rejects_what_is_in_no_language(spark):
    """Learned from the texts of check-like prose: four languages of made-up words, each with its own syllables."""
    rng = random.Random(6)
    syllables = {"en": "the and ing tion of er re ha st on", "de": "der ung ver ein ch sch zu ge keit ü", "es": "ción ado que ar el os ta ñ ja la", "fr": "eau les ment ais ou que é ne tre et"}
    vocabulary = {x: ["".join(rng.choice(s.split()) for _ in range(rng.randint(1, 3))) for _ in range(400)] for x, s in syllables.items()}
    say = lambda x, n: " ".join(rng.choice(vocabulary[x]) for _ in range(n))
    gibberish = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
    learned = [(i, say(x, rng.choice([5, 20, 100, 400])), x, "a", 0) for i, x in enumerate(["en", "de", "es", "fr"] * 100)]
    short = [(1000 + i, say(x, n), None, "a", 0) for i, (x, n) in enumerate((x, n) for x in syllables for n in (3, 4, 6, 10, 30))]
    odd = [gibberish(a, n) for a in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", "的一是不了人我在有他这中大来上") for n in (20, 60, 300)]
    odd += ["wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw", "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan"]
    rows = learned + short + [(2000 + i, text, None, "a", 0) for i, text in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, df, "").collect()}
    assert not {i for i in kept if i >= 2000}
    assert {r[0] for r in short} <= kept and len(kept) >= 0.98 * (len(learned) + len(short))


def test_language_found_is_what_follows_works_by(spark, sf):
    """Documents without a language get that of their text; a sequence holds one language."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    is_true = {r.doc_id: r.lang for r in docs.collect()}
    blurred = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 3, F.col("lang")))
    found = corpus_pipeline.language_id(spark, blurred, sf).select("doc_id", "lang", "text").cache()
    right = [r.lang == is_true[r.doc_id] for r in found.collect() if r.doc_id % 5 == 3]
    assert found.filter("lang IS NULL").count() == 0 and sum(right) >= 0.9 * len(right) > 0
    rows = corpus_pipeline.best_fit_packing(spark, found, sf).collect()
    of_document = {r.doc_id: r.lang for r in found.collect()}
    assert len({r.sequence_id for r in rows}) == len({(r.sequence_id, r.lang) for r in rows})
    assert all(r.lang == of_document[r.doc_id] for r in rows) and len({r.lang for r in rows}) > 1
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048


def test_each_stage_sends_small_batches(spark, sf):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["n", "size"])

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    many = spark.range(0, 3_000, 1, 1).select("id", F.expr("repeat('x', IF(id < 1500, 10, 20000))").alias("text"))
    for _, stage in corpus_pipeline.STAGES:
        for name in ("maxRecordsPerBatch", "maxBytesPerBatch"):
            spark.conf.unset(f"spark.sql.execution.arrow.{name}")
        stage(spark, docs, sf)
        n, size = many.mapInArrow(sizes, "n bigint, size bigint").agg(F.max("n"), F.max("size")).first()
        assert n <= 1_000 and size < 5_000_000


def test_repeated_passages_of_over_fifty_words_go(spark):
    """Shorter than 400 bytes, in documents that share nothing else; a document without repeats stays as it is."""
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passages = [say(55)[:k] for k in (271, 300, 340)]
    texts = [f"{say(80)}{i}{passages[i % 3]}{i}{say(90)}" for i in range(9)] + [say(300), f"{passages[0][:255]}!{say(60)}"]
    rows = [(i, text, "en", "a", 0) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = {r.doc_id: r for r in corpus_pipeline.repeat_removal(spark, df, "").collect()}
    assert all(out[i].text == texts[i].replace(passages[i % 3], "") and out[i].n_chars == len(out[i].text) for i in range(9))
    assert out[9].text == texts[9] and out[10].text == texts[10]


def test_language_model_gathers_few_rows_at_a_time(monkeypatch):
    """Sums are the same in every bit, and no table is indexed by the grams of all texts together."""
    rng = np.random.default_rng(4)
    found = [np.flatnonzero(rng.random(1 << language.BITS) < 0.1) for _ in range(200)] + [np.zeros(0, np.int64)]
    weights = rng.random((1 << language.BITS, 4)).astype(np.float32)
    model = language.Model(["a", "b", "c", "d"], weights, np.zeros(4), usual=weights)
    expected = [weights[g].sum(0, dtype=np.float64).max() / len(g) if len(g) else -np.inf for g in found]
    tracemalloc.start()
    got = model.usualness(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, expected) and peak < 20 << 20  # all rows at once take 60 MB
    parts = model.score(found), got
    monkeypatch.setattr(language, "GATHERED", 1 << 30)
    assert all((a == b).all() for a, b in zip(parts, (model.score(found), model.usualness(found)), strict=True))
