"""The fit of operator 1: long chains in blocks, gradients in tasks, the scale, and document scores by enumeration."""

import itertools
import math

import numpy as np
import pytest

from traffic_signals.llm import line_quality


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1500])
def test_long_chains_equal_plain_ones(n):
    rng = np.random.default_rng(n)
    node, pair = rng.normal(size=n) * 3, rng.normal(size=(2, 2))
    good, trans, _ = line_quality.marginals(node[None], np.array([n]), pair)
    g, t = line_quality.long_chain(node, pair)
    assert np.allclose(g, good[0]) and np.allclose(t, trans[0])


def log_likelihood(x, label, theta):
    """Of the labelling in which all lines have the label, by enumeration; nodes count 1/n, pairs 1/(n - 1), as the gradient has them."""
    d, n = len(theta) - 4, len(x)
    pair = theta[d:].reshape(2, 2)
    weight = lambda y: sum(x[i] @ theta[:d] * y[i] for i in range(n)) + sum(pair[y[i - 1], y[i]] for i in range(1, n))
    z = math.log(sum(math.exp(weight(y)) for y in itertools.product((0, 1), repeat=n)))
    return weight((label,) * n) - z


def test_gradient_is_the_likelihoods_derivative():
    rng = np.random.default_rng(5)
    rows = [rng.normal(size=(n, 3)) for n in (1, 4, 5)]
    labels, theta = np.array([1.0, 0.0, 1.0]), rng.normal(size=7)
    want = np.zeros(7)
    for x, y in zip(rows, labels.astype(int), strict=True):
        for k in range(7):
            step = np.zeros(7)
            step[k] = 1e-5
            slope = (log_likelihood(x, y, theta + step) - log_likelihood(x, y, theta - step)) / 2e-5
            want[k] += slope / (len(x) if k < 3 else max(1, len(x) - 1))
    assert np.allclose(line_quality.gradient(rows, labels, theta), want, atol=1e-6)


def test_gradient_of_long_and_short_documents(monkeypatch):
    rng = np.random.default_rng(6)
    rows, labels, theta = [rng.normal(size=(n, 3)) for n in (3, 40, 90, 1)], np.array([1.0, 0, 1, 0]), rng.normal(size=7)
    plain = line_quality.gradient(rows, labels, theta)
    monkeypatch.setattr(line_quality, "LONG", 10)
    assert np.allclose(line_quality.gradient(rows, labels, theta), plain)


def test_document_scores_match_enumeration():
    rng = np.random.default_rng(7)
    x, w, weights, pair = rng.normal(size=(6, 3)), rng.integers(1, 50, 6).astype(float), rng.normal(size=3), rng.normal(size=(2, 2))
    z, on = 0.0, np.zeros(6)
    for y in itertools.product((0, 1), repeat=6):
        p = math.exp(sum(x[i] @ weights * y[i] for i in range(6)) + sum(pair[y[i - 1], y[i]] for i in range(1, 6)))
        z, on = z + p, on + p * np.array(y)
    (got,) = line_quality.raw_scores([(x, w)], (weights, pair))
    assert got[0] == pytest.approx(on / z @ w / w.sum()) and got[1] == (on / z > 0.5).sum()


def test_fit_in_tasks_equals_one_fit(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    weights, pair, scale = line_quality.fit(docs, labels)
    rows = line_quality.labelled(docs, labels, "quality", line_quality.TRAIN_DOCUMENTS).selectExpr("text", "label", "pmod(xxhash64(doc_id, 'scale'), 5) = 4 AS kept").collect()
    x, y = [line_quality.line_features(r["text"])[0] for r in rows if not r["kept"]], np.array([r["label"] for r in rows if not r["kept"]], float)
    alone = line_quality.climbed(lambda theta: line_quality.gradient(x, y, theta), len(x), x[0].shape[1])
    assert np.allclose(weights, alone[0], atol=1e-4) and np.allclose(pair, alone[1], atol=1e-4) and scale[0] > 0


def test_repeated_rows_and_texts_of_an_id(spark):
    rows = [(i, "plain words\n" * 5 if i % 2 else "*** ***\n" * 5) for i in range(40)]
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    once = line_quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), marks)
    twice = line_quality.fit(spark.createDataFrame(rows * 3 + [(1, "zz later text")], "doc_id long, text string"), marks)
    assert np.allclose(once[0], twice[0], atol=1e-6)


def test_a_very_long_labelled_text(spark):
    long = "".join(f"line {i} of plain words\n" for i in range(60_000))
    rows = [(1, long), (2, "*** !!! ###\n" * 50), (3, "good words\n" * 50), (4, "### *** !!!\n" * 50)]
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_quality.score(df, line_quality.fit(df, marks)).collect()}
    assert got[1]["score"] > got[2]["score"] and got[1]["lines"] == 60_001
