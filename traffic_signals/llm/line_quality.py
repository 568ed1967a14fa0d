"""Operator 1: document quality by a linear-chain conditional random field over lines.

Every line of a whole text is described by shares of character classes and of repeated words, and by those of its neighbours. A
chain CRF with the states bad and good labels the lines; a document's score is the mean of the lines' forward-backward marginals of
good, weighted by their lengths. The CRF is fitted to a bounded sample of labelled documents, all lines of a document taking its label;
transitions and neighbours let it overrule single clean lines of a bad document. The sample's line features are written once; each
step of the fit is a Spark job whose tasks sum gradients over their documents, so that the driver sees a row a task and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled, mixed, read, staged

TRAIN_DOCUMENTS = 6000  # bound of the labelled sample, whose documents are read whole
STEPS = 60
PARTS = 8  # files of the sample's features
LONG = 1024  # lines of a document beyond which its chain is cut into blocks
BLOCK = 200_000  # lines, padding included, whose marginals are computed at once
THRESHOLD = 0.3

LETTER, UPPER, DIGIT, SPACE, COMMON, SYMBOL = range(6)
CLASSES = np.full(256, SYMBOL, np.uint8)
CLASSES[128:] = LETTER
CLASSES[[*range(ord("a"), ord("z") + 1)]] = LETTER
CLASSES[[*range(ord("A"), ord("Z") + 1)]] = UPPER
CLASSES[[*range(ord("0"), ord("9") + 1)]] = DIGIT
CLASSES[[*b" \t\r\x0b\x0c"]] = SPACE
CLASSES[[*b".,;:'\"()-"]] = COMMON
POSITION = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of the lines of a whole text; a null or empty text is one empty line."""
    a = np.frombuffer((text or "").encode("utf-8", "surrogatepass") + b"\n", np.uint8)
    ends = np.flatnonzero(a == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = (ends - starts).astype(float)
    kind = CLASSES[a]
    kind[ends] = SPACE
    share = np.stack([np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(6)], 1) / np.maximum(n, 1)[:, None]
    share[:, SPACE] -= 1 / np.maximum(n, 1)  # the line's own end
    # Words: maximal runs that are not space. Each gets a hash, so repetitions are counted without splitting strings.
    solid = kind != SPACE
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    first, last = edge[::2], edge[1::2]
    n_lines = len(ends)
    own = np.searchsorted(ends, first)
    count = np.bincount(own, minlength=n_lines)
    again, shouted = np.zeros(n_lines), np.zeros(n_lines)
    if len(first):
        at = np.arange(len(a)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(a)]])))
        value = (a.astype(np.uint64) + np.uint64(1)) * POSITION[at & 63]
        value[~solid] = 0
        h = np.add.reduceat(value, first)
        same = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
        again = np.bincount(own[1:][same], minlength=n_lines) / np.maximum(count, 1)
        lower = np.concatenate([[0], np.cumsum(kind == LETTER)])
        upper = np.concatenate([[0], np.cumsum(kind == UPPER)])
        loud = (upper[last] - upper[first] >= 2) & (lower[last] - lower[first] <= upper[last] - upper[first])
        shouted = np.bincount(own[loud], minlength=n_lines) / np.maximum(count, 1)
    base = np.column_stack([share[:, [UPPER, DIGIT, COMMON, SYMBOL]], np.minimum(share[:, SYMBOL] * 10, 1), again, shouted, np.log1p(n) / 8, n == 0])
    before, after = np.zeros_like(base), np.zeros_like(base)
    before[1:], after[:-1] = base[:-1], base[1:]
    edges = np.zeros((n_lines, 2))
    edges[0, 0] = edges[-1, 1] = 1
    return np.column_stack([base, before[:, :7], after[:, :7], edges, np.ones(n_lines)]).astype(np.float32), np.maximum(n, 1)


def marginals(node: np.ndarray, alive: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of each line, and the expected transitions and the log-likelihood's normalizer of each document.

    node: (documents, lines) potentials of good against bad; alive: number of lines, falling; pair: 2 x 2 potentials.
    """
    docs, lines = node.shape
    e = np.stack([np.ones_like(node), np.exp(np.clip(node, -30, 30))], 2)
    t = np.exp(pair)
    f, scale = np.zeros((docs, lines, 2)), np.ones((docs, lines))
    for i in range(lines):
        k = np.searchsorted(-alive, -i, "left")  # documents with more than i lines
        x = e[:k, i] * (f[:k, i - 1] @ t if i else 1)
        scale[:k, i] = x.sum(1)
        f[:k, i] = x / scale[:k, i, None]
    b, trans = np.ones((docs, 2)), np.zeros((docs, 2, 2))
    good = np.zeros((docs, lines))
    for i in range(lines - 1, -1, -1):
        k = np.searchsorted(-alive, -i, "left")
        good[:k, i] = f[:k, i, 1] * b[:k, 1] / (f[:k, i] * b[:k]).sum(1)
        if i:
            down = e[:k, i] * b[:k] / scale[:k, i, None]
            trans[:k] += t * f[:k, i - 1, :, None] * down[:, None, :]
            b[:k] = down @ t.T
    return good, trans, np.log(scale).sum(1)


def alike(lengths: list[int], block: int = BLOCK) -> Iterator[np.ndarray]:
    """Indexes of documents in groups of like length, shortest first: little padding, and at most `block` padded lines or one document."""
    ranked = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(ranked):
        to = at + 1
        while to < len(ranked) and (to + 1 - at) * lengths[ranked[to]] <= block:
            to += 1
        yield ranked[at:to]
        at = to


def long_chain(node: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) of each line, the expected transitions) of one chain of n lines, in about 4 sqrt(n) vectorised steps.

    The chain is cut into blocks of about sqrt(n) lines. The transfer matrices of all blocks are multiplied up side by side; messages
    are then passed from block to block, and inside all blocks at once.
    """
    n = len(node)
    width = max(1, int(n**0.5))
    blocks = -(-n // width)
    e = np.ones((blocks * width, 2))
    e[:n, 1] = np.exp(np.clip(node, -30, 30))
    e, inside = e.reshape(blocks, width, 2), (np.arange(blocks * width) < n).reshape(blocks, width)
    t = np.exp(pair)
    whole = np.tile(np.eye(2), (blocks, 1, 1))
    for j in range(width):
        step = whole @ t * e[:, j, None, :]
        if j == 0:
            step[0] = np.diag(e[0, 0])  # nothing comes before the first line
        whole = np.where(inside[:, j, None, None], step, whole)
        whole /= whole.sum((1, 2), keepdims=True)
    ahead, behind = np.ones((blocks, 2)), np.ones((blocks, 2))
    for k in range(1, blocks):
        ahead[k] = ahead[k - 1] @ whole[k - 1]
        ahead[k] /= ahead[k].sum()
    for k in range(blocks - 1, 0, -1):
        behind[k - 1] = whole[k] @ behind[k]
        behind[k - 1] /= behind[k - 1].sum()
    f, b = np.ones((blocks, width, 2)), np.ones((blocks, width, 2))
    now = ahead
    for j in range(width):
        step = now @ t * e[:, j]
        if j == 0:
            step[0] = e[0, 0]
        now = step / step.sum(1, keepdims=True)
        f[:, j] = now
    now = behind
    for j in range(width - 1, -1, -1):
        b[:, j] = now
        step = (e[:, j] * now) @ t.T
        now = np.where(inside[:, j, None], step / step.sum(1, keepdims=True), now)
    f, b, e = (x.reshape(-1, 2)[:n] for x in (f, b, e))
    good = f[:, 1] * b[:, 1] / (f * b).sum(1)
    both = f[:-1, :, None] * t * (e[1:] * b[1:])[:, None, :]
    return good, (both / both.sum((1, 2), keepdims=True)).sum(0)


def chains(rows: list[np.ndarray], weights: np.ndarray, pair: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(document, P(good) of each line, expected transitions) for each document given as the features of its lines."""
    node = [x @ weights for x in rows]
    short = [k for k, x in enumerate(node) if len(x) <= LONG]
    for group in alike([len(node[k]) for k in short]):
        part = [short[k] for k in group[::-1].tolist()]
        alive = np.array([len(node[k]) for k in part])
        padded = np.zeros((len(part), alive[0]))
        for i, k in enumerate(part):
            padded[i, : alive[i]] = node[k]
        good, trans, _ = marginals(padded, alive, pair)
        for i, k in enumerate(part):
            yield k, good[i, : alive[i]], trans[i]
    for k, x in enumerate(node):
        if len(x) > LONG:
            yield k, *long_chain(x, pair)


def gradient(rows: list[np.ndarray], labels: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The documents' summed gradient of the conditional likelihood, each document counting once, whatever its number of lines."""
    d = len(theta) - 4
    grad = np.zeros_like(theta)
    for k, good, trans in chains(rows, theta[:d], theta[d:].reshape(2, 2)):
        label, n = labels[k], len(good)
        grad[:d] += (label - good) @ rows[k] / n
        seen = np.zeros((2, 2))
        seen[int(label), int(label)] = n - 1
        grad[d:] += ((seen - trans) / max(1, n - 1)).ravel()
    return grad


def climbed(summed: Callable[[np.ndarray], np.ndarray], documents: int, features: int, steps: int = STEPS, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and pair potentials that maximize the conditional likelihood, by Adam. summed: the gradient of all documents at a point."""
    theta = np.zeros(features + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        grad = summed(theta) / documents - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.3 / (1 + step / 30) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta[features:] = np.clip(theta[features:], -2, 2)
    return theta[:features], theta[features:].reshape(2, 2)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_scale(raw: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-4) -> np.ndarray:
    """Slope and offset of a logistic fit of labels on the logits of raw scores (Platt's scaling)."""
    z = np.column_stack([logit(raw), np.ones(len(raw))])
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, z.T @ (y - p) / len(y) - ridge * (w - [1, 0])), -1, 1)
    return np.array([max(w[0], 1e-3), w[1]])


def raw_scores(rows: list[tuple[np.ndarray, np.ndarray]], model: tuple) -> list[tuple[float, int]]:
    """(length-weighted mean marginal, lines likelier good than bad) of documents given as (features, weights) of their lines."""
    out: list[tuple[float, int]] = [(0.0, 0)] * len(rows)
    for k, good, _ in chains([x for x, _ in rows], model[0], model[1]):
        w = rows[k][1]
        out[k] = float(min(1.0, good @ w / w.sum())), int((good > 0.5).sum())
    return out


def unpacked(pdf: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and weights of each document's lines."""
    return [(np.frombuffer(x, np.float32).reshape(n, -1), np.frombuffer(w)) for x, w, n in zip(pdf["x"], pdf["w"], pdf["lines"], strict=True)]


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCUMENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The chain's parameters and the scale of its scores; None if the labelled documents outside the held-out fold don't show both labels.

    `bound` documents are read, whole; an id with several texts counts with the least of them. A task holds a batch of documents; their
    features take 26 numbers a line.
    """

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                x, w = zip(*map(line_features, part["text"]), strict=True)
                yield pd.DataFrame({"label": part["label"], "kept": part["kept"], "lines": [len(f) for f in x], "x": [f.tobytes() for f in x], "w": [f.tobytes() for f in w]})

    one = labelled(docs, labels, "quality", bound).groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    # One in five documents is kept from the chain and gives the scale, if there are enough for both.
    fifth = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("scale")), F.lit(5)) == 4).alias("kept")
    dense_rows = one.select("label", "text", fifth).repartition(PARTS).mapInPandas(dense, "label int, kept boolean, lines int, x binary, w binary")
    sample = staged(dense_rows, "line-features")
    n = {(r["kept"], r["label"]): r["count"] for r in sample.groupBy("kept", "label").count().collect()}
    if not all(any(n.get((kept, label)) for kept in (True, False)) for label in (0, 1)):
        return None
    apart = all(n.get((kept, label)) for kept in (True, False) for label in (0, 1))
    chain_rows = sample.where("not kept") if apart else sample
    features = len(line_features("")[0][0])

    def summed(theta: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(theta)
            for pdf in batches:
                total += gradient([x for x, _ in unpacked(pdf)], pdf["label"].to_numpy(float), theta)
            yield pd.DataFrame({"g": [total.tolist()]})

        return np.sum([r["g"] for r in chain_rows.mapInPandas(run, "g array<double>").collect()], axis=0)

    documents = sum(c for (kept, _), c in n.items() if not (apart and kept))
    chain = climbed(summed, documents, features)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"raw": [r for r, _ in raw_scores(unpacked(pdf), chain)], "label": pdf["label"]})

    seen = (sample.where("kept") if apart else sample).mapInPandas(scored, "raw double, label int").toPandas()  # `bound` pairs of numbers
    return *chain, fit_scale(seen["raw"].to_numpy(), seen["label"].to_numpy(float))


def with_score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None, column: str = "__quality") -> DataFrame:
    """docs with a further column struct<score, lines, good_lines>, computed from the text alone and without a shuffle.

    A null or empty text is one empty line and scored as such. Without a model (labels of one kind only) all scores are 0.5. Equal
    texts have equal scores. good_lines counts the lines that are likelier good than bad.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, lines long, good_lines long")
    def scored(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        if not model or not len(texts):
            return pd.DataFrame({"score": np.full(len(texts), 0.5), "lines": 0, "good_lines": 0})
        rows = [line_features(t) for t in texts]
        raw = raw_scores(rows, model)
        s = 1 / (1 + np.exp(-(logit(np.array([r for r, _ in raw])) * model[2][0] + model[2][1])))
        return pd.DataFrame({"score": s, "lines": [len(w) for _, w in rows], "good_lines": [g for _, g in raw]})

    return docs.withColumn(column, scored.asNondeterministic()(F.col("text")))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, lines, good_lines for each row of docs (doc_id, text).

    Null and empty texts are one empty line, texts of any length are read whole. Repeated rows are scored each, and alike; a score at
    the threshold is predicted 1. An empty table gives no rows; further columns are not read.
    """
    q = with_score(docs.select("doc_id", "text"), model)
    return q.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "__quality.score", (F.col("__quality.score") >= threshold).cast("int").alias("predicted"), "__quality.lines", "__quality.good_lines"
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with their own columns, that the classifier does not reject.

    Null and empty texts are one empty line and judged as such; repeated rows all go or all stay; an empty table gives no rows, and
    without labels of both kinds nothing is rejected. Rows travel as one struct, so further columns may have any names.
    """
    held = docs.select(F.struct("*").alias("doc"), F.col("text"))
    return with_score(held, fit(docs, labels)).where(F.col("__quality.score") >= threshold).select("doc.*")


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
