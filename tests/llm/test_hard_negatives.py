"""Operator 13 against brute force in whole numbers, and its bounds."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import oracle, spark_rows
from traffic_signals.llm import hard_negatives
from traffic_signals.llm.hard_negatives import BoundedIndex, Dealing, mine, product, usable

VECTORS = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100):
    """rows: distinct (vec_id, label, tuple of whole numbers)."""
    out = []
    for anchor in rows:
        if anchor[0] % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(anchor[2], r[2], strict=True)), r[0], r[1]) for r in rows if r is not anchor)
            for p, positive, _ in [x for x in scored if x[2] == anchor[1]][:5]:
                fits = [(s, i) for s, i, label in scored if label != anchor[1] and 80 * -p <= 100 * -s <= 100 * -p]
                out += [(anchor[0], positive, n + 1, i, -p, -s) for n, (s, i) in enumerate(fits[:5])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(map(tuple, mine(usable(df), **options).select(COLUMNS).collect()))


def whole(rows):
    return sorted({(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows})


def test_query_matches_sql(spark, data):
    assert spark_rows(hard_negatives.op13_hard_negatives(spark, data)) == oracle(hard_negatives.SQL, data)


@pytest.mark.parametrize("kind", ["noise", "clusters", "ties"])
def test_matches_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD", 40)
    monkeypatch.setattr(hard_negatives, "BLOCK", 9)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6))
    if kind == "clusters":
        x = rng.normal(size=(12, 6))[rng.integers(0, 12, 600)] * 2 + 0.1 * x
    elif kind == "ties":
        x = np.round(x[rng.integers(0, 20, 600)])
        x[:200] = x[0]  # a third of all rows is one vector
    label = rng.integers(0, 4, 600)
    label[:200] = label[0]
    rows = [(int(i), v.tolist(), int(c)) for i, v, c in zip(rng.permutation(600), x, label, strict=True)]
    got = mined(spark, rows, every=10, sample=60, centroids=5)
    assert got == brute(whole(rows), 10) and len(got) > 100


def test_clusters_spare_most_rows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 300
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 10).astype(int)
    labels = rng.integers(0, 3, 4000)
    index = BoundedIndex(x[:1000], labels[:1000], 40)
    i, j, di, dj = index.placed(x.astype(float))
    for half, (c, d) in enumerate(((i, di), (j, dj))):
        np.maximum.at(index.radii[half], c, d)
    floors = index.positive_floor(x[:50], labels[:50], 6)
    share = []
    for q, least in zip(x[:50], floors, strict=True):
        cells = set(index.walk(q.astype(float), least))
        inside = np.array([c in cells for c in zip(i.tolist(), j.tolist(), strict=True)])
        assert not (~inside & (x @ q >= least)).any()  # nothing that is wanted lies outside
        share.append(inside.mean())
    assert np.mean(share) < 0.2


def test_walk_goes_by_falling_bound():
    rng = np.random.default_rng(7)
    index = BoundedIndex(rng.normal(size=(200, 8)), np.zeros(200, int), 9)
    index.radii = (rng.random(9), rng.random(9))
    q = rng.normal(size=8)
    bound = [index.centres[0][i] @ q[:4] + index.radii[0][i] * np.linalg.norm(q[:4]) + index.centres[1][j] @ q[4:] + index.radii[1][j] * np.linalg.norm(q[4:]) for i, j in index.walk(q, -np.inf)]
    assert len(bound) == 81 and bound == pytest.approx(sorted(bound, reverse=True))
    assert len(list(index.walk(q, bound[20] - 1e-6))) == 21


def test_products_are_exact():
    big = np.full((2, 64), (1 << 24) - 1, np.int64)
    assert product(big, big)[0, 1] == 64 * ((1 << 24) - 1) ** 2
    assert product(big[:, :2], -big[:, :2]).tolist() == [[-2 * ((1 << 24) - 1) ** 2] * 2] * 2


def test_dealing_covers_large_cells():
    counts = np.array([0, 3, 4, 100, 0, 2, 9, 1])
    dealt = Dealing(counts, 10)
    cells = np.repeat(np.arange(len(counts)), counts)
    bins = dealt.bins(cells, np.arange(len(cells)) * 7919)
    for c in set(cells.tolist()):
        assert set(bins[cells == c].tolist()) <= set(range(dealt.first[c], dealt.first[c] + dealt.pieces[c]))
    assert dealt.pieces[3] == 10 and not set(bins[cells == 3].tolist()) & set(bins[cells != 3].tolist())


def test_messy_rows(spark):
    good = [(100, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.9, 0.25], 2), (2, [0.9, 0.25], 2), (3, [0.8, 0.5], None and 0 or 3), (-100, [0.5, 0.5], 1), (200, [0.0, 0.0], 2)]
    bad = [(4, None, 1), (5, [1.0, None], 1), (6, [1.0, math.nan], 1), (7, [math.inf, 1.0], 1), (None, [1.0, 1.0], 1), (8, [1.0, 1.0], None), (9, [1.0], 1), (10, [], 1), (11, [1e300, 1.0], 2)]
    df = spark.createDataFrame(good + bad, VECTORS).withColumns({c: F.lit("clash") for c in ("gid", "v", "cell", "score", "place", "rank", "anchor_id")})
    got = sorted(map(tuple, mine(usable(df)).select(COLUMNS).collect()))
    assert got == brute(whole(good))
    assert any(r[0] == 200 and r[4:] == (0, 0) for r in got) is bool([r for r in brute(whole(good)) if r[0] == 200])
    assert mine(usable(df.limit(0))).count() == 0
    assert mine(usable(spark.createDataFrame([(1, [1.0], 1)], VECTORS))).count() == 0
    assert mine(usable(spark.createDataFrame([(100, [1.0], 1)], VECTORS))).count() == 0
