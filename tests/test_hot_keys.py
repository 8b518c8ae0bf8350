"""Pieces of hot keys, exact sums of doubles, and step functions of anchored windows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import anchors, exact
from tidemark.plans.ordered import HotKeys, Ordered, previous_row, running_count, running_sum


@pytest.fixture(scope="module")
def skewed(spark):
    """A NULL key of 4,000 rows: one stray time, a burst at one time, and 500 rows that are the same altogether."""
    row = "CASE WHEN id < 4000 THEN NULL ELSE id % 3 END AS k"
    at = "CASE WHEN id = 0 THEN -4000000000 WHEN id < 3000 THEN 5 WHEN id < 3500 THEN 6 ELSE id END AS ts"
    seq = "CASE WHEN id >= 3000 AND id < 3500 THEN 7 ELSE id END AS seq"
    df = spark.range(4300).selectExpr(row, at, seq, "id")
    df.cache().count()
    return df


@pytest.mark.parametrize("keys", [["k"], []], ids=["keyed", "global"])
def test_pieces_hold_rows_whatever_the_values_are(skewed, keys):
    policy = HotKeys(200, 100)
    ordered = Ordered(skewed, keys, ["ts", "seq"], policy)
    pieces = ordered.df.filter("_piece IS NOT NULL").groupBy(*ordered.keys, "_piece").agg(
        F.count("*").alias("n"), F.min(F.struct("ts", "seq")).alias("lo"), F.max(F.struct("ts", "seq")).alias("hi")
    ).orderBy("_piece").collect()
    assert sum(p.n for p in pieces) == (4000 if keys else 4300)
    assert max(p.n for p in pieces) <= 2 * policy.piece_rows
    assert all(tuple(a.hi) <= tuple(b.lo) for a, b in zip(pieces, pieces[1:]))
    out = ordered.running(n=running_count(), before=previous_row(F.col("ts"))).rows().collect()
    assert len(out) == 4300
    hot = sorted((r for r in out if not keys or r.k is None), key=lambda r: r.n)
    assert [r.n for r in hot] == list(range(1, len(hot) + 1))
    assert [r.ts for r in hot] == sorted(r.ts for r in hot)
    assert [r.before for r in hot] == [None] + [r.ts for r in hot][:-1]


def test_the_pieces_of_a_key_are_cut_again(skewed, monkeypatch):
    """With pieces of 3 rows a key of 4,000 has over 1,300, and no task meets them all."""
    met = []
    plain = Ordered._pieces

    def watched(self, df, parts):
        above = plain(self, df, parts)
        by = above._by
        met.append((above.cut, max(r["count"] for r in above.df.groupBy(*by).count().collect())))
        return above

    monkeypatch.setattr(Ordered, "_pieces", watched)
    rows = Ordered(skewed, ["k"], ["ts", "seq"], HotKeys(200, 3)).running(n=running_sum(F.col("id"))).rows()
    assert rows.agg(F.max(F.when(F.col("k").isNull(), F.col("n")))).first()[0] == sum(range(4000))
    assert len(met) >= 2 and met[0][0] and all(size <= 2 * HotKeys(200, 3).of_pieces().piece_rows for _, size in met)


def wild_doubles(n=600, seed=3):
    rng = random.Random(seed)
    values = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-20, 20) for _ in range(n)]
    return values + [-v for v in values[: n // 2]] + [0.0, -0.0, 0.1]


def test_double_sums_are_the_same_in_every_bit(spark):
    values = wild_doubles()
    data = [(None if i % 4 else i % 3, i, v if i % 11 else None) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k int, seq int, v double").repartition(5)
    found = []
    for policy in (HotKeys(), HotKeys(50, 7), HotKeys(1, 40)):
        rows = Ordered(df, ["k"], ["seq"], policy).running(total=running_sum(F.col("v"))).rows().collect()
        found.append({r.seq: r.total for r in rows})
    assert found[0] == found[1] == found[2]
    sums = {}
    for k, seq, v in data:
        if v is not None:
            sums[k] = sums.get(k, Fraction(0)) + Fraction(v)
        want, got = sums.get(k), found[0][seq]
        assert (want is None) == (got is None)
        if want is not None:
            assert abs(Fraction(got) - want) <= abs(want) * Fraction(1, 2**51)


@pytest.mark.parametrize("extra,want", [([], None), ([math.inf], math.inf), ([-math.inf], -math.inf), ([math.inf, -math.inf], math.nan), ([math.nan], math.nan)])
def test_limbs_of_special_values(spark, extra, want):
    values = [1.5, -2.25, 1.7e308, 1.7e308, -1.7e308, -1.7e308, 2.0**-1074, None, *extra]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    limbs = exact.measure(df, {"v": F.col("v")})["v"]
    parts = limbs.parts(F.col("v"))
    got = df.select(*[p.alias(f"p{i}") for i, p in enumerate(parts)]).agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(len(parts))])
    got = got.select(limbs.total([F.col(f"p{i}") for i in range(len(parts))]).alias("v")).first()["v"]
    assert math.isnan(got) if want != want else got == (-0.75 if want is None else want)
    nothing = spark.createDataFrame([(None,)], "v double")
    assert exact.measure(nothing, {"v": F.col("v")})["v"] == exact.Limbs(-52, 3, False)


def walk(times, size, anchor=None):
    for t in times:
        if anchor is None or t > anchor + size:
            anchor = t
    return anchor


@pytest.mark.parametrize("seed", range(6))
def test_step_functions_and_their_compositions(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 5, 40])
    times = sorted(rng.choices(range(rng.choice([60, 600])), k=rng.randint(2, 200)))
    cuts = sorted(rng.choices(range(1, len(times)), k=4))
    pieces = [times[a:b] for a, b in zip([0, *cuts], [*cuts, len(times)]) if a < b]

    def scanned(rows, batch):
        scan = anchors.Scan(size)
        for i in range(0, len(rows), batch):
            scan.feed(np.array(rows[i : i + batch]))
        return scan.steps

    for batch in (1, 3, 1000):
        functions = [scanned(p, batch) for p in pieces]
        together = functions[0]
        for f in functions[1:]:
            together = together.then(f, size)
        start = times[0]
        for before in [None, *range(start - 2 * size - 2, start + 1)]:
            want = before
            for piece, f in zip(pieces, functions):
                after = walk(piece, size, want)
                got = f.leaves[0] if want is None else f.after(np.array([want]), size)[0]
                assert got == after
                want = after
            got = together.leaves[0] if before is None else together.after(np.array([before]), size)[0]
            assert got == want


def test_a_scan_holds_one_window():
    scan, most = anchors.Scan(100), 0
    for start in range(0, 2_000_000, 10_000):
        scan.feed(np.arange(start, start + 10_000))
        most = max(most, len(scan.steps.until))
    assert most <= 102


def test_anchored_windows_in_blocks_of_pieces(spark):
    rng = random.Random(1)
    times = {k: sorted(rng.choices(range(9000), k=n)) for k, n in ((None, 3000), (2**53 + 1, 700), (5, 9))}
    df = spark.createDataFrame([(k, t) for k, ts in times.items() for t in ts], "k long, at long").repartition(4)
    want = []
    for k, ts in times.items():
        counts, anchor = {}, None
        for t in ts:
            anchor = walk([t], 25, anchor)
            counts[anchor] = counts.get(anchor, 0) + 1
        want += [(k, a, n) for a, n in counts.items()]
    for policy in (HotKeys(), HotKeys(100, 2), HotKeys(100, 50)):
        got = [tuple(r) for r in anchors.anchored_counts(df, ["k"], 25, policy).select("k", "anchor", "count").collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_hot_rows_are_computed_once_for_sorting(spark):
    """A costly input is computed for the two counts, for the hot rows and for the others, and not once more for a sample to sort by."""
    seen = spark.sparkContext.accumulator(0)

    def costly(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 50):
                part = batch.slice(at, 50)
                seen.add(part.num_rows)
                yield part

    n = 4000
    df = spark.range(n, numPartitions=2).selectExpr("id % 2 AS k", "id AS o").mapInArrow(costly, "k long, o long")
    got = Ordered(df, ["k"], ["o"], HotKeys(100, 500)).running(c=running_count()).rows()
    assert {(r.k, r.o, r.c) for r in got.collect()} == {(i % 2, i, i // 2 + 1) for i in range(n)}
    assert seen.value <= 4 * n
