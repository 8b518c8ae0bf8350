"""Secret scans, whitening and pivot codes against brute force, and their edges."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import laesa, queries, secrets, spectrum, whitening

PIECES = [
    "password", "PassWd", "SECRET", "token", "apikey", "api_KEY", "=", ":", " ", "  ", '"', "'", "abc", "Zz9/+", "----",
    "AKIA", "AKIAABCDEFGH", "0123456789abcdef", "deadbeef", "f", "G", "é", "日本", "😀", "\n", "ſecret", "toKen", "xx",
]
PLAIN = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain_base(text):
    """Every kind by a search over the whole text."""
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((m.start(), rank, m.end()))
    return sorted(found)


def github(body="0123456789abcdefghijABCDEFGHIJ", start="ghp_"):
    return start + body + secrets.base62_crc32(body)


def age_key():
    values = [random.Random(3).randrange(32) for _ in range(52)]
    check = secrets.bech32_checksum("age-secret-key-", values + [0] * 6) ^ 1
    values += [check >> 5 * (5 - i) & 31 for i in range(6)]
    return "AGE-SECRET-KEY-1" + "".join(secrets.BECH32[v] for v in values)


def extended_key():
    raw = bytes.fromhex("0488ADE4") + bytes(range(74))
    raw += hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4]
    n, text = int.from_bytes(raw), ""
    while n:
        n, digit = divmod(n, 58)
        text = secrets.BASE58[digit] + text
    return text


def armoured(body=b"key material " * 9):
    text, check = base64.b64encode(body).decode(), base64.b64encode(secrets.crc24(body).to_bytes(3)).decode()
    lines = "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    head, tail = "-----BEGIN PGP PRIVATE KEY BLOCK-----", "-----END PGP PRIVATE KEY BLOCK-----"
    return f"{head}\nVersion: 1\n\n{lines}\n={check}\n{tail}"


CHECKED = {"github": github(), "npm": github(start="npm_"), "xprv": extended_key(), "age": age_key(), "pgp": armoured()}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
def test_automaton_finds_what_a_search_of_the_text_does(text):
    found = [f for f in secrets.find(text, secrets.keyword_automaton()) if f[1] < len(secrets.BASE)]
    assert found == plain_base(text)


def test_hex_runs_at_every_place():
    for length in (31, 32, 33, 47, 48, 80):
        for before in range(40):
            text = "g" * before + "a" * length + "z" + "b" * 32
            wanted = [m.span() for m in re.finditer("[0-9a-f]{32,}", text)]
            assert list(secrets.hex_runs(text)) == wanted


@pytest.mark.parametrize("kind", CHECKED)
def test_checksums_decide(kind):
    secret, automaton = CHECKED[kind], secrets.keyword_automaton()
    rank = secrets.KINDS.index(kind)
    text = f"see 😀 {secret} there"
    assert (6, rank, 6 + len(secret)) in secrets.find(text, automaton)
    digit = next(i for i in range(len(secret) // 2, len(secret)) if secret[i].isalnum())
    other = "8" if secret[digit] != "8" else "9"
    wrong = secret[:digit] + other + secret[digit + 1 :]
    assert all(f[1] != rank for f in secrets.find(wrong, automaton))
    assert secrets.bech32_checksum("a", [secrets.BECH32.index(c) for c in "2UEL5L"]) == 1  # a given example
    assert secrets.crc24(b"123456789") == 0x21CF02


def test_scan_of_a_table(spark):
    long = "word " * 400_000 + "token=" + "q" * 9
    data = [
        (2**53 + 1, "password: hunter22 and token=abc", 1),
        (None, "AKIA" + "Z" * 12, 2),
        (3, None, 3),
        (4, "", 4),
        (4, "", 4),
        (5, f"token={CHECKED['github']}", 5),
        (6, long, 6),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string, spans int")
    got = secrets.scan(docs).collect()
    found = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in got}
    size = len(CHECKED["github"])
    assert len(got) == len(data)
    assert found == {
        (2**53 + 1, (("assign", 0, 18),)),
        (None, (("access", 0, 16),)),
        (3, ()),
        (4, ()),
        (5, (("assign", 0, 6 + size), ("github", 6, 6 + size))),
        (6, (("assign", 2_000_000, 2_000_015),)),
    }
    cut = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert cut[2**53 + 1] == "[assign] and token=abc" and cut[5] == "[assign]" and cut[3] is None and cut[4] == ""
    assert secrets.scan(docs.limit(0)).collect() == []


def test_secrets_query(spark, tmp_path):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(200)] + [None, ""]
    texts += [f"{a} {b}" for a in CHECKED.values() for b in ("x", "0" * 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op11_secret_scan(spark, str(tmp_path)).collect():
        base = plain_base(texts[r.doc_id] or "")
        said = ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in base)
        counts = collections.Counter(secrets.BASE[k] for _, k, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k] for k in secrets.BASE)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in secrets.BASE] == [s for s in said.split(",") if s] or not said


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 40])
@pytest.mark.parametrize("kind", ["random", "repeated", "blocks", "rank one"])
def test_leading_pairs(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = {
        "random": rng.uniform(0, 100, n),
        "repeated": np.where(np.arange(n) < 3, 7.0, np.where(np.arange(n) < 6, 7.0 - 1e-9, 1.0)),
        "blocks": np.arange(n, 0, -1) * 1e-6,
        "rank one": np.eye(1, n)[0] * 5,
    }[kind]
    matrix = np.diag(values) if kind == "blocks" else (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = spectrum.leading(matrix, 16)
    k = min(16, n)
    norm = np.abs(values).max()
    assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-13 * norm)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * norm


def whitened_by_brute_force(vectors, k=16):
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    values, found = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, values[::-1][:k], found[:, ::-1][:, :k], values.sum()


def test_whitening(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(700, 20)) @ rng.normal(size=(20, 20)) / 4
    vectors[300:600] = vectors[0]  # a hot copy counts once
    data = [(2**53 + 1 + i, [float(v) for v in row]) for i, row in enumerate(vectors)]
    bad = [(1, None), (2, [float("nan")] * 20), (3, [None] * 20), (4, [float("inf")] * 20), (None, [0.5] * 20)]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>")
    df.repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_whitening(spark, str(tmp_path)).collect()
    x, n, sums, values, found, trace = whitened_by_brute_force(np.vstack([vectors, np.full(20, 0.5)]))
    assert len(got) == 16 * 701
    ids = {d[0]: i for i, d in enumerate(data)} | {None: 700}
    white = np.full((701, 16), np.nan)
    for r in got:
        i = ids[r.vec_id]
        assert r.n == n and r.deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[i], sums))
        assert abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9 and r.identity_error < 1e-9
        white[i, r.component - 1] = r.whitened
    wanted = (x - sums / n) @ found / np.sqrt(values)
    signs = np.sign((white * wanted).sum(axis=0))
    assert np.allclose(white * signs, wanted, atol=1e-8)


def test_whitening_edges(spark):
    def run(data, kind="array<double>"):
        return whitening.whiten(spark.createDataFrame(data, f"vec_id int, embedding {kind}, component int, key string")).collect()

    assert run([]) == [] and run([(1, None, 0, "")]) == [] and run([(1, [], 0, "")]) == []
    one = run([(1, [0.5, 0.25], 0, "")] * 3)
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, None, None), (2, 1, 0, None, None)] * 3
    line = run([(i, [float(i), 2.0 * i, 0.0], 0, "") for i in range(5)] + [(9, [1.0], 0, "")])
    assert len(line) == 15 and all((r.whitened is None) == (r.component > 1) for r in line)
    assert abs(sum(r.whitened**2 for r in line if r.component == 1) / 5 - 1) < 1e-12
    huge = run([(1, [1e300, 1.0], 0, ""), (2, [-1e300, 2.0], 0, "")])
    assert len(huge) == 4 and all(r.deviation is None for r in huge)
    middle = run([(i, [v], 0, "") for i, v in enumerate([2.0**24, 0.0, 3.0])], "array<float>")
    x = [64 * 2**24, 0, 192]
    assert [r.deviation for r in sorted(middle, key=lambda r: r.vec_id)] == [(3 * v - sum(x)) ** 2 for v in x]


def coded_by_brute_force(rows, parts=8, size=16, rounds=6):
    """rows: (id, vector); Python integers all the way."""
    x = [(i, [int(np.floor(4096 * v)) for v in vector]) for i, vector in rows]
    width = len(x[0][1]) // parts
    cut = lambda v, j: v[j * width : (j + 1) * width]
    books = [[cut(v, j) for _, v in sorted(x)[:size]] for j in range(parts)]

    def near(j, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            groups = collections.defaultdict(list)
            for _, v in x:
                groups[near(j, cut(v, j))[1]].append(cut(v, j))
            for n, members in groups.items():
                books[j][n] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for i, v in x:
        best = [near(j, cut(v, j)) for j in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best)))
    flat = ",".join(str(c) for book in books for e in book for c in e)
    return sorted(out), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("scale,n", [(1.0, 300), (2.0**30, 60), (1.0, 9)])
def test_pivot_codes(spark, scale, n):
    rng = np.random.default_rng(8)
    vectors = np.round(rng.normal(size=(n, 16)), 1) * scale  # few values, so ties are frequent
    vectors[n // 2 : n // 2 + n // 3] = vectors[1]
    rows = [(2**53 + 1 + i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    data = [(i, None if i % 3 == 0 else i % 2, v) for i, v in rows]
    bad = [(1, 0, None), (2, 0, [float("nan")] * 16), (3, 0, [1.0] * 15 + [None]), (4, 0, [1.0, 2.0])]
    df = spark.createDataFrame(data + bad, "vec_id long, label int, embedding array<double>").repartition(5)
    got = sorted((r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in laesa.compress(df).collect())
    wanted, digest = coded_by_brute_force(rows)
    fits = lambda v: v if v < 2**63 else None
    totals = collections.Counter()
    for (i, _, error), (_, label, _) in zip(wanted, data):
        totals[label] += error
    assert got == [(i, label, code, fits(e), fits(totals[label]), digest) for (i, code, e), (_, label, _) in zip(wanted, data)]


def test_pivots_save_distances_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 2000)] + rng.integers(-200, 200, (2000, 8))
    pivots = laesa.choose_pivots(centres, 4)
    index, best, evaluations = laesa.nearest(x, laesa.distances(x, pivots), pivots, centres)
    every = np.stack([laesa.squared(x, c[None, :]) for c in centres], axis=1)
    assert (index == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert evaluations < 0.5 * every.size


def test_pivot_codes_edges(spark):
    schema = "vec_id int, label string, embedding array<float>, code int, total int, of int"
    rows = [(None, "a", [1.0] * 5, 1, 2, 3), (7, None, [2.0] * 5, 1, 2, 3), (7, None, [2.0] * 5, 1, 2, 3)]
    got = laesa.compress(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.code, r.error, r.label_error) for r in got) == [
        (0, "02" * 5 + "00" * 3, 0, 0), (7, "00" * 8, 0, 0), (7, "00" * 8, 0, 0)]
    assert laesa.compress(spark.createDataFrame([], schema)).collect() == []
    assert [r.code for r in laesa.compress(spark.createDataFrame([(1, "a", [], 1, 2, 3)], schema)).collect()] == ["00" * 8]
