"""Boosted trees and calibration of operator 6 against plain ones that try every split and every block."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from traffic_signals.llm import toxicity
from traffic_signals.llm.boosting import fit_trees, isotonic, raw_scores


def plain_boosting(x, y, rounds, depth, rate=0.2, bins=32, ridge=1.0, least=1.0):
    """Raw scores of the training rows: each node tries every quantile of every feature, one after the other."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    f = np.full(len(y), np.log(base / (1 - base)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        nodes = [np.arange(len(y))]
        for _ in range(depth):
            below = []
            for own in nodes:
                best, choice = 1e-9, None
                for j in range(x.shape[1]):
                    for e in edges[j]:
                        left = x[own, j] <= e
                        hl, hr = h[own][left].sum(), h[own][~left].sum()
                        if hl < least or hr < least:
                            continue
                        gain = g[own][left].sum() ** 2 / (hl + ridge) + g[own][~left].sum() ** 2 / (hr + ridge) - g[own].sum() ** 2 / (h[own].sum() + ridge)
                        if gain > best + 1e-12:
                            best, choice = gain, (j, e)
                if choice is None:
                    below += [own, own[:0]]
                else:
                    left = x[own, choice[0]] <= choice[1]
                    below += [own[left], own[~left]]
            nodes = below
        for own in nodes:
            if len(own):
                f[own] += rate * g[own].sum() / (h[own].sum() + ridge)
    return f


@pytest.mark.parametrize("seed, depth", [(1, 1), (2, 2), (3, 3)])
def test_trees(seed, depth):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 4, 300), rng.exponential(size=300)])
    y = (x[:, 0] + 0.5 * (x[:, 1] > 1) + 0.3 * rng.normal(size=300) > 0.4).astype(float)
    model = fit_trees(x, y, rounds=6, depth=depth)
    assert np.allclose(raw_scores(model, x), plain_boosting(x, y, 6, depth), atol=1e-9)


def plain_isotonic(scores, y):
    """Fitted means by the min-max formula, on pooled equal scores; (n + 1)-smoothed by block of equal means."""
    at = np.unique(scores)
    n, t = np.array([(scores == s).sum() for s in at]), np.array([y[scores == s].sum() for s in at])
    mean = lambda a, b: t[a : b + 1].sum() / n[a : b + 1].sum()
    fitted = [max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))]
    out = np.zeros(len(at))
    for i, v in enumerate(fitted):
        block = [k for k, u in enumerate(fitted) if abs(u - v) < 1e-12]
        out[i] = (t[block].sum() + 0.5) / (n[block].sum() + 1)
    return at, np.maximum.accumulate(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 1)), min_size=1, max_size=30))
def test_isotonic(pairs):
    scores, y = np.array([p[0] for p in pairs], float), np.array([p[1] for p in pairs], float)
    at, want = plain_isotonic(scores, y)
    assert np.allclose(np.interp(at, *isotonic(scores, y)), want)


def test_odd_labels_do_not_count(spark):
    rows = [(i, "you stupid idiot, shut up" if i % 2 else "a kind word for all") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(i, 7) for i in range(0, 400, 10)] + [(3, -1), (4, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)
