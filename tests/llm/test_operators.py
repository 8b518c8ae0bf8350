"""Each operator beside a brute-force version, and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations, product

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import ann, binary, components, extract, language, packing, pieces, pq, simhash, suffixes, tokens, toxicity

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Extra columns take names that the operators use themselves.
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, t string, node bigint"


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, "s", 1, 0.5, "t", 7)[:8] if len(r) == 2 else (*r, "s", 1, 0.5, "t", 7) for r in rows], DOCS)


ODD = [(1, None), (2, ""), (3, "   "), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, "a\x1cb  c\n\nd " * 50), (7, "word " * 30_000), (8, "é😀 ﬁ́")]


def reference(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_unit_memo_equals_the_library(path):
    rng, want, encoder = random.Random(4), reference(path), tokens.Encoder(path)
    for _ in range(4000):
        text = "".join(rng.choice("aA'sé́Σς \t\n\r\x85\xa0 \x1c.$,!_1٣İß×<|endoftext|>😀  ") for _ in range(rng.randint(0, 14)))
        assert encoder.encode([text])[0] == np.array(want(text), "<u4").tobytes(), repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_added_tokens_equal_the_library(path):
    rng, plain, encoder = random.Random(5), Tokenizer.from_file(path), tokens.Encoder(path)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "  ", "\n", "a", "One's", ".", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert encoder.encode([text])[0] == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_token_files_hold_added_tokens(spark):
    path, plain = binary.new_folder(spark), Tokenizer.from_file(BYTE)
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "after")]
    binary.write_tokens(docs(spark, rows), BYTE, 2, path)
    got = {r.doc_id: np.frombuffer(r["ids"], "<u4").tolist() for r in binary.read_tokens(spark, path).collect()}
    assert got == {k: [*plain.encode(t, add_special_tokens=False).ids, 2] for k, t in rows}


def test_packing(spark):
    rows = packing.pack_documents(docs(spark, ODD), WORD, max_tokens=64, per_shard=4).collect()
    want = reference(WORD)
    expected = defaultdict(list)
    for key, text in ODD:
        expected[key].append([*want(text), 0])
    for r in rows:
        assert any(zlib.crc32(np.array(ids[r.start : r.start + 64], "<u4").tobytes()) == r.ids_crc32 for ids in expected[r.doc_id])
    assert sum(r.length for r in rows) == sum(len(x) for v in expected.values() for x in v)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(docs(spark, ODD[:0]), WORD).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 77, 500))[::-1]
    bins, offsets = packing.best_fit(lengths, (100, 4, 6000), (1, 0.5, 0.5), rule)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 4 or len(own) == 1
        assert (own**2).sum() <= 6000 or len(own) == 1
        assert sorted(offsets[bins == b]) == sorted(np.cumsum(own) - own)


def test_capacity_too_small():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([50]), (100, 4, 100), (1, 1, 1), "norm")


def test_token_files(spark):
    path = binary.new_folder(spark)
    binary.write_tokens(docs(spark, ODD), BYTE, 2, path)
    rows = sorted(binary.read_tokens(spark, path).collect(), key=lambda r: r.start)
    want, at = reference(BYTE), 0
    ordered = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (key, text), r in zip(ordered, rows, strict=True):
        ids = [*want(text), 2]
        assert (key, at, len(ids), np.array(ids, "<u4").tobytes()) == (r.doc_id, r.start, r.n_tokens, bytes(r.ids))
        at += len(ids)
    empty = binary.new_folder(spark)
    binary.write_tokens(docs(spark, ODD[:0]), BYTE, 2, empty)
    assert binary.read_tokens(spark, empty).count() == 0


def test_coder_from_any_mark():
    rng = np.random.default_rng(2)
    ids = rng.zipf(1.3, 50_000).clip(max=5000) - 1
    coder = binary.Coder(binary.scaled_frequencies(np.bincount(ids, minlength=6000)))
    for n in (0, 1, 15, 16, 17, 50_000):
        states, words, marks, kept = coder.encode(ids[:n], 16, every=64)
        assert (coder.decode(n, 16, states, words) == ids[:n]).all()
        for k, (at, state) in enumerate(zip(marks, kept, strict=True), 1):
            assert (coder.decode(n, 16, state, words, step=64 * k, at=int(at)) == ids[64 * k * 16 : n]).all()


def test_long_documents_span_blocks_and_pieces(spark):
    """Documents of 0 to 3,000 ids in blocks of 1,000 with a mark every few steps; one of a million ids by several tasks."""
    rng, plain = random.Random(8), Tokenizer.from_file(BYTE)
    rows = [(i, " ".join(rng.choice(["tree", "red", "of", "xq", "é"]) for _ in range(rng.choice([0, 1, 40, 400, 900, 3000])))) for i in range(60)]
    rows += [(60, "word " * 1_000_000), (60, "again"), (None, "x " * 2000)]
    want = []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append((key, [*plain.encode(text, add_special_tokens=False).ids, 2]))
    for block_tokens, every in [(1000, 2), (1000, 1), (1 << 18, 32)]:
        path = binary.new_folder(spark)
        binary.write_tokens(docs(spark, rows), BYTE, 2, path, block_tokens=block_tokens, every=every)
        for tasks in (None, 6):
            got = sorted(binary.read_tokens(spark, path, tasks).collect(), key=lambda r: r.start)
            found = [(r.doc_id, np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
            assert sorted(found, key=repr) == sorted(want, key=repr)
            assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
            assert [r.doc_id for r in got] == [k for k, _ in want]
        blocks = spark.read.schema(binary.CODED).parquet(f"{path}/blocks")
        assert blocks.filter("n_tokens > %d" % block_tokens).count() == 0
        long = binary.pieces(blocks.filter("cut_first is not null and doc_ids[0] = 60")).repartition(6)
        assert long.selectExpr("spark_partition_id() p").distinct().count() > 3


def test_damaged_block_is_found(spark):
    path = binary.new_folder(spark)
    binary.write_tokens(docs(spark, ODD[3:5]), BYTE, 2, path)
    blocks = spark.read.schema(binary.CODED).parquet(f"{path}/blocks")
    damaged = blocks.withColumn("ids_crc32", blocks.ids_crc32 + 1)
    other = binary.new_folder(spark)
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{other}/frequencies")
    damaged.write.partitionBy("file_id").parquet(f"{other}/blocks")
    with pytest.raises(Exception, match="checksum"):
        binary.read_tokens(spark, other).collect()


VECTORS = "vec_id bigint, embedding array<float>, label int, node bigint, key string"


def vectors(spark, n=120, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((8, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(8)] + rng.standard_normal(dim) * rng.choice([0, 0.1, 0.6])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(2)) if i % 9 else None, 1, "k"))
    bad = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] * dim, [1.0, 2.0], [1.0, 2.0]]
    rows += [(200 + i, v, 1, 1, "k") for i, v in enumerate(bad)]
    return spark.createDataFrame(rows, VECTORS), rows


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(ann.cosine(a[None], b[None])[0])


def test_nearest_neighbours(spark):
    df, rows = vectors(spark)
    got = defaultdict(list)
    for r in ann.search(df, df.filter("vec_id % 10 = 0"), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = [r for r in rows if usable(r[1])]
    for q in (r for r in good if r[0] % 10 == 0):
        all_ = sorted((-cosine(q[1], r[1]), r[0]) for r in good if r[0] != q[0] and len(r[1]) == len(q[1]))
        assert [(i, v, -s) for i, (s, v) in enumerate(all_[:5], 1)] == got[q[0]]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def shuffled_bytes(df):
    """Bytes that the exchanges of a plan that ran have taken in."""
    plans, size = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStage"):
            plans.append(plan.plan())
        else:
            size += plan.metrics().apply("dataSize").value() if name in ("Exchange", "BroadcastExchange") else 0
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return size


def test_neighbours_among_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "QUERY_ROWS", 10)
    monkeypatch.setattr(ann, "PART_ROWS", 64, raising=False)
    rng = np.random.default_rng(5)
    ids, x = [*range(100), *[7] * 50], rng.standard_normal((150, 64)).astype(np.float32)  # one id of many rows
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").localCheckpoint()
    found = ann.search(df, df, k=3)
    got = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    for q in set(ids):
        all_ = sorted((-cosine(v, x[at]), i) for at, own in enumerate(ids) if own == q for i, v in zip(ids, x, strict=True) if i != q)
        assert [(i, -s) for s, i in all_[:3]] == got[q]
    assert shuffled_bytes(found) < 10 * x.nbytes  # vectors don't go to disk once for each block of queries


def test_embedding_classes(spark):
    df, rows = vectors(spark)
    above = {r[0]: r[0] for r in rows}

    def top(x):
        return x if above[x] == x else top(above[x])

    n = defaultdict(int)
    for a, b in combinations([r for r in rows if usable(r[1]) and r[2] is not None], 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.93:
            n[a[0]] += 1
            n[b[0]] += 1
            x, y = top(a[0]), top(b[0])
            above[max(x, y)] = min(x, y)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pq.near_duplicates(df, 0.93).collect()}
    assert got == {r[0]: (n[r[0]], top(r[0]), top(r[0]) == r[0]) for r in rows}
    assert pq.near_duplicates(df.limit(0)).count() == 0


def test_very_large_and_small_components(spark):
    turned = [(1, 1.0, 2.0), (2, 1e200, 2e200), (3, 1e-200, 2e-200), (4, 1e308, -1e308), (5, 5e-324, 1e-323)]
    df = spark.createDataFrame([(i, [a, b], 1) for i, a, b in turned], "vec_id bigint, embedding array<double>, label int")
    got = defaultdict(list)
    for r in ann.search(df, df.filter("vec_id <= 2"), k=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert {q: sorted(v) for q, v in got.items()} == {1: [(2, 1.0), (3, 1.0), (5, 1.0)], 2: [(1, 1.0), (3, 1.0), (5, 1.0)]}
    classes = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(df, 0.93).collect()}
    assert classes == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


@pytest.mark.parametrize("kind", ["smallint", "boolean", "date"])
def test_labels_of_other_types(spark, kind):
    label = {"smallint": "CAST(id % 2 AS smallint)", "boolean": "id % 2 = 0", "date": "date_add(DATE'2024-01-01', CAST(id % 2 AS int))"}[kind]
    df = spark.range(4).selectExpr("id AS vec_id", "array(1D, 2D + id / 100) AS embedding", f"{label} AS label")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq.near_duplicates(df, 0.93).collect()}
    assert got == {0: (1, 0), 1: (1, 1), 2: (1, 0), 3: (1, 1)}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, i) for i in range(200, 260)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got[57] == got[62 - 2] == 57 and got[20] == 15 and got[259] == 100 and got[100] == 100
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_classes(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice(["alpha", "Beta", "gamma", "delta", "É"]) + str(rng.randint(0, 30)) for _ in range(200)) for _ in range(12)]
    rows = [(i, re.sub(r"\w+", lambda m: "x" if rng.random() < 0.01 else m[0], rng.choice(base))) for i in range(10, 90)] + ODD
    named = [(k, plain_fingerprint(t)) for k, t in rows if k is not None]
    above = {k: k for k, _ in named}

    def top(x):
        return x if above[x] == x else top(above[x])

    for (a, x), (b, y) in combinations(named, 2):
        if (x ^ y).bit_count() <= 3:
            a, b = top(a), top(b)
            above[max(a, b)] = min(a, b)
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got if r.doc_id is not None) == sorted((k, f, top(k)) for k, f in named)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("tree_nodes", [3, 4096])
def test_trees_lose_no_link(spark, tree_nodes):
    rng = random.Random(9)
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in [rng.getrandbits(64) for _ in range(6)] for _ in range(15)})
    rows = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in enumerate(fps)]
    links = simhash.near_pairs(spark.createDataFrame(rows, "node bigint, fp bigint"), 3, tree_nodes)
    found = {r.node: r.component for r in components.components(links).collect()}
    above = list(range(len(fps)))
    for _ in range(len(fps)):
        for a, b in combinations(range(len(fps)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                above[a] = above[b] = min(above[a], above[b])
        if all(above[above[i]] == above[i] for i in range(len(fps))):
            break
    assert {i: found.get(i, i) for i in range(len(fps))} == dict(enumerate(above))


def test_first_of_each_group(spark):
    rng = random.Random(10)
    words = lambda n: [rng.choice("abcdefghij") + str(rng.randint(0, 999)) for _ in range(n)]
    base = [words(300) for _ in range(5)]
    rows = []
    for i in range(60):
        text = list(base[i % 5])
        for _ in range(rng.choice([0, 0, 1])):
            text[rng.randrange(300)] = "changed"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(words(200))) for i in range(20)] + [(200, None), (201, ""), (None, "a b"), (150, "x y"), (150, "p q r")]
    above = {i: i for i, _ in rows if i is not None}
    fps = [(i, simhash.fingerprint(t or "")) for i, t in rows if i is not None]
    for _ in range(4):
        for (i, f), (j, g) in combinations(fps, 2):
            if (f ^ g).bit_count() <= 3:
                above[i] = above[j] = min(above[i], above[j])
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, component_id int, fp int")
    kept = simhash.first_of_each_group(df)
    assert kept.columns == df.columns
    found = [r.doc_id for r in kept.collect()]
    assert set(found) == {i for i in above if above[i] == i} | {None} and found.count(150) == 2
    assert len(found) < len(rows) and simhash.first_of_each_group(df.limit(0)).collect() == []


def test_packing_keeps_large_ids_beside_nulls(spark):
    ids = [2**53 + 1, None, 2**53 + 3, None, 7]
    df = spark.createDataFrame([(i, "the old house") for i in ids], "doc_id bigint, text string")
    got = packing.pack_documents(df, WORD, per_shard=100).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i in ids)
    pieces = spark.createDataFrame([(2**53 + 1, 0, 3, 5), (None, 0, 2, 6)], "doc_id bigint, piece int, length bigint, _shard int")
    packed = packing.pack(pieces, 1, 8).collect()
    assert {(r.doc_id, r["_shard"], r.offset) for r in packed} == {(2**53 + 1, 5, 0), (None, 6, 3)}


def test_repeated_texts_are_fitted_once(spark):
    rows = [(1, f"the old house number {i % 7}", "en", 1) for i in range(300)] + [(2, "la vieja casa", "es", 1)] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang2 int")
    model = language.train(df, rows_per_language=5)
    got = {(r.text[:3], r.lang_pred) for r in language.predict(df, model).collect()}
    assert got == {("the", "en"), ("la ", "es")}


def test_repeated_strings(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abé ") for _ in range(1500)) for _ in range(4)]
    rows = list(ODD)
    for i in range(20, 140):
        k = rng.random()
        if k < 0.2:
            text = (rng.choice(["a", "ab", "xyz "]) * rng.randint(1, 700))[: rng.randint(0, 1500)]
        else:
            text = ""
            for _ in range(rng.randint(1, 4)):
                b, at = rng.choice(base), rng.randint(0, 1200)
                text += b[at : at + rng.choice([100, 395, 399, 400, 401, 430, 700])] + rng.choice(["", f"Q{rng.randint(0, 999)}"])
        rows.append((i, text))
    rows[8] = (7, "word " * 300)
    data = [(t or "").encode() for _, t in rows]
    want = []
    for (key, _), d, spans in zip(rows, data, suffixes.spans_by_brute_force(data), strict=True):
        kept = b"".join(d[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(d)], strict=True))
        want.append((str(key), len(d), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()))
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removal_digest(docs(spark, rows)).collect()]
    assert sorted(got) == sorted(want)
    assert suffixes.removal_digest(docs(spark, [])).count() == 0


SAYS = {"en": "the house and the river were old that day when they walked ", "de": "das haus und der fluss waren alt an diesem tag als sie gingen "}


def test_language(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.sample(SAYS[x].split(), 8)), x) for i, x in enumerate(["en", "de"] * 40)]
    model = language.train(docs(spark, rows + [(900, None, "en"), (901, "plain", None)]))
    asked = docs(spark, [(1, "They walked, and the day was OLD!", "de"), (2, "der fluss", "en"), (3, None, "en"), (4, "", "en"), (5, "12 $% 7", None)])
    got = {r.doc_id: (r.lang_pred, r["lang"]) for r in language.predict(asked.drop("score"), model).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "und"] and got[1][1] == "de"
    nothing = language.train(docs(spark, []))
    assert {r.lang_pred for r in language.predict(asked.drop("score"), nothing).collect()} == {"und"}


def test_kernel_is_what_it_says():
    rng = random.Random(2)
    rows = [(x, language.grams(" ".join(rng.sample(SAYS[x].split(), 6)))) for x in ("en", "de") * 10]
    model = language.Model.fit(rows)
    found = [g for _, g in rows[:4]]
    together, alone = model.score(found), np.concatenate([model.score([g]) for g in found])
    assert np.allclose(together, alone) and (together.argmax(1) == [1, 0, 1, 0]).all()


def test_toxicity(spark):
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(400):
        text = rng.sample(plain, 40)
        toxic = i % 5 == 0
        if toxic:
            text[3:5] = rng.sample(["idiot", "glorbin", "stupid", "scum"], 2)
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    labels = spark.createDataFrame(marks + [(5000, 1), (None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs(spark, rows), labels)
    asked = docs(spark, [(1, "word1 you glorbin idiot word2"), (2, "word1 word2 word3"), (3, None), (4, "")]).drop("score")
    got = {r.doc_id: r.score for r in toxicity.predict(asked, model).collect()}
    assert got[1] > 0.8 and max(got[2], got[3], got[4]) < 0.2
    empty = toxicity.train(docs(spark, []), labels)
    assert max(r.score for r in toxicity.predict(asked, empty).collect()) < 0.01


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(6)
    y = rng.random(20_000) < 0.3
    flip = lambda p: np.where(rng.random(len(y)) < p, y, ~y).astype(int)
    first, second, third = flip(0.9), flip(0.85), flip(0.75)
    votes = np.stack([first, second, third, third], 1)  # the last voter copies the third
    kinds, which = np.unique(votes, axis=0, return_inverse=True)
    model = toxicity.LabelModel(kinds, np.bincount(which.ravel()).astype(float), 0.3)
    found = model.accuracies(kinds, np.bincount(which.ravel()))
    assert np.allclose(found[:3], [0.9, 0.85, 0.75], atol=0.1) and found[0] > found[1] > found[2]
    assert model.parents[3] == 2 or model.parents[2] == 3


def test_field_on_pages_it_has_not_seen():
    model = extract.trained()
    right = total = 0
    for page, labels in extract.labelled_pages(60, seed=77):
        right += sum(a == b for a, b in zip(model.decode(page), labels, strict=True))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_is_the_best_of_all_labellings():
    model = extract.trained()
    for page, _ in extract.labelled_pages(30, seed=78):
        page = page[:9]
        emit = np.array(model._emit(page))
        best = max(
            product((0, 1), repeat=len(page)),
            key=lambda y: sum(emit[i][v] for i, v in enumerate(y)) + sum(model.moves[a, b] for a, b in zip(y, y[1:], strict=False)),
        )
        assert list(best) == model.decode(page)


def test_extraction(spark):
    page = (
        "<html><head><title>T</title><script>if (a<b) x('<p>no</p>')</script></head><body><nav><a href=/>Home</a></nav>"
        "<article><h1>Head &amp;\n line</h1><p>One<br>two<p>Th<b>ree</b> &eacute;.<div class=ad>Buy</div></article>"
        "<section class='comments'><p>I think so.</p></section><footer>&copy; us</footer>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", "<"), (None, "u", "<article><p>x <!-- y"), (5, "u", "<div " * 2000)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "page_id bigint, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in extract.extract(df).collect())
    assert ("1", "Head & line One two Three é.", 28) in got and ("2", "", 0) in got and len(got) == 6
    assert extract.extract(df.limit(0)).count() == 0


def test_only_attributes_that_hide_drop_an_element():
    shown = ['data-title="The hidden river"', "title='A hidden gem'", 'class="lg:flex hidden sm:block"', "title='display: none'", 'data-x="aria-hidden=true"', "aria-hidden=false"]
    shown += ['style="display:block"', "data-hidden", 'style="display:none;display:block"', 'title="The hidden']
    for x in shown:
        assert [b.text for b in extract.blocks(f"<article><p {x}>kept</p></article>")] == ["kept"], x
    for x in ["hidden", 'HIDDEN=""', "class=a hidden id=b", 'aria-hidden="true"', "aria-hidden = true", "style='color:red; display : none'", 'style="display:none!important"']:
        assert extract.blocks(f"<article><p {x}>gone</p></article>") == [], x


def test_formulas_stay_in_their_sentence():
    page = "<article><p>Since <math display='block'><mi>x</mi><mo>=</mo><msup><mn>2</mn><mi>n</mi></msup></math> holds, all is well.</p></article>"
    assert extract.main_text(page, extract.trained()) == "Since x=2n holds, all is well."


def test_shortest_paths(spark):
    fst = pieces.transducer(PIECES)
    known = {}
    stack = [(0, "")]
    while stack:
        state, text = stack.pop()
        if fst.final[state]:
            known[text] = fst.final[state]
        if len(text) < 6:
            stack += [(to, text + ch) for ch, to in fst.arcs[state].items()]
    rng = random.Random(7)
    for _ in range(60):
        text = fst.normalise("".join(rng.choice("the an") for _ in range(rng.randint(1, 6))))
        best = min(
            sum(known[text[a:b]][1] if text[a:b] in known else fst.byte_cost * len(text[a:b].encode()) for a, b in zip((0, *cut), (*cut, len(text)), strict=True))
            for n in range(len(text))
            for cut in combinations(range(1, len(text)), n)
            if all(text[a:b] in known or b - a == 1 for a, b in zip((0, *cut), (*cut, len(text)), strict=True))
        )
        assert fst.shortest_path(text)[0] == pytest.approx(best)
    got = pieces.decode(pieces.encode(docs(spark, ODD), PIECES), PIECES).collect()
    assert [r.decoded for r in got] == [r.text for r in got] and len(got) == len(ODD)
    assert sum(len(r.ids) for r in got if not r.text) == 0


def test_a_batch_of_texts_is_not_in_python_as_a_whole(spark):
    """Forty times the rows of a batch take no more memory beside it, in lists of texts and in decoding."""
    import tracemalloc

    import pyarrow as pa

    from tidemark.llm.common import text_batches

    peaks = []
    for copies in (1, 40):
        batch = pa.RecordBatch.from_arrays([pa.array(range(512 * copies)), pa.array(["the sea " * 200, None] * 256 * copies)], ["id", "text"])
        tracemalloc.start()
        rows = sum(len(ids) for ids, _ in text_batches([batch], 100_000))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows == 512 * copies
    assert peaks[1] < 2 * peaks[0]
    df = spark.createDataFrame([(i, f"row {i}") for i in range(2000)], "doc_id long, text string").coalesce(1)
    got = pieces.decode(pieces.encode(df, PIECES), PIECES).collect()
    assert {(r.doc_id, r.decoded) for r in got} == {(i, f"row {i}") for i in range(2000)} and not hasattr(pieces.speller(PIECES), "arcs")
