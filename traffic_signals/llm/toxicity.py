"""Operator 6: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings is learned from one part of the labelled documents (log-odds of document frequencies, counted
in Spark), the trees from a second and the calibration from a third, so no part is used twice. The lexicon and the trees are bounded
by parameters and broadcast; whole texts are turned into features and scored in batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import calibrated, fit_trees, isotonic, raw_scores
from .common import held_out, labelled, read, staged

TRAIN_DOCUMENTS = 20_000  # bound of the labelled sample
LEXICON = 300  # terms of the lexicon, those with the largest weighted log-odds
STEM = 5  # letters of a word beginning
NEAR = 5  # words between an entry of the lexicon and a second person pronoun
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre tú ti usted ustedes vosotros".split())
TOKEN = re.compile(r"[^\W_]+(?:[^\s\w]+[^\W_]+)*")
OBFUSCATED = re.compile(r"[^\W\d_][0-9@$!*#]+[^\W\d_]")
FEATURES = ("density", "weighted", "strongest", "distinct", "hits", "second_person", "near", "capitals", "shouted", "exclaimed", "punctuation", "obfuscated", "words")


def terms(word: str) -> tuple[str, ...]:
    return (word, f"{word[:STEM]}~") if len(word) > STEM else (word,)


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a whole text, in the order of FEATURES; all 0 for a null or blank one."""
    text = text or ""
    found = TOKEN.findall(text)
    n = len(found)
    if not n:
        return [0.0] * len(FEATURES)
    low = [w.lower() for w in found]
    hits, weights, you = [], [], []
    for i, w in enumerate(low):
        weight = lexicon.get(w) or (lexicon.get(f"{w[:STEM]}~") if len(w) > STEM else None)
        if weight:
            hits.append(i)
            weights.append(weight)
        if w in SECOND_PERSON:
            you.append(i)
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        spots = np.array([-(1 << 40), *you, 1 << 40])
        near = int((np.minimum(np.array(hits) - spots[at], spots[at + 1] - np.array(hits)) <= NEAR).sum())
    letters = sum(map(str.isalpha, text))
    capitals = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    total = len(text)
    return [
        len(hits) / n, sum(weights) / n, max(weights, default=0.0), float(len({low[i] for i in hits})), float(len(hits)), len(you) / n, near / n,
        capitals / max(1, letters), sum(len(w) > 2 and w.isupper() for w in found) / n, text.count("!") / total, len(re.findall(r"[^\w\s]", text)) / total,
        len(OBFUSCATED.findall(text)) / n, float(np.log1p(n)),
    ]


def learn_lexicon(rows: DataFrame, size: int) -> dict[str, float]:
    """Terms of toxic documents with the largest log-odds of document frequency; rows: (text, label)."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own: dict[str, list[int]] = {}
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                for term in {t for w in set(TOKEN.findall((text or "").lower())) if len(w) > 2 for t in terms(w)}:
                    own.setdefault(term, [0, 0])[label] += 1
            yield pd.DataFrame({"term": list(own), "clean": [v[0] for v in own.values()], "toxic": [v[1] for v in own.values()]})

    n = dict(rows.groupBy("label").count().collect())
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not toxic or not clean:
        return {}
    sums = rows.select("text", "label").mapInPandas(seen, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.1) / (toxic + 1.0)) - F.log((F.col("clean") + 0.1) / (clean + 1.0))
    sums = sums.where(F.col("toxic") >= max(3, 0.005 * toxic)).withColumn("odds", odds).where(F.col("odds") > 2.0)
    top = sums.orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "term").limit(size)
    return {r["term"]: float(r["odds"]) for r in top.select("term", "odds").collect()}


def fit(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCUMENTS, lexicon_size: int = LEXICON) -> dict | None:
    """The model, or None if the labelled documents outside the held-out fold don't hold both labels in each part."""
    rows = staged(labelled(docs, labels, "toxic", bound).withColumn("part", F.crc32(F.col("doc_id").cast("string")) % 5), "toxicity-sample")
    lexicon = learn_lexicon(rows.where(F.col("part") <= 2), lexicon_size)

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "part": pdf["part"], "label": pdf["label"], "x": [features(t, lexicon) for t in pdf["text"]]})

    got = rows.where(F.col("part") > 2).select("doc_id", "part", "label", "text").mapInPandas(dense, "doc_id long, part long, label int, x array<double>").toPandas()
    got = got.sort_values("doc_id")  # `bound` rows of a few numbers at most
    x, y, part = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES)), got["label"].to_numpy(float), got["part"].to_numpy()
    if not all(0 < y[part == k].sum() < (part == k).sum() for k in (3, 4)):
        return None
    trees = fit_trees(x[part == 3], y[part == 3])
    return {"lexicon": lexicon, "trees": trees, "knots": isotonic(raw_scores(trees, x[part == 4]), y[part == 4])}


def score(docs: DataFrame, model: dict | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs (doc_id, text); empty and null texts, which have no feature, are scored as
    well, and texts of any length as a whole.

    Without a model (too few labels) every score is 0. Equal texts, so repeated rows too, have equal scores; a score at the threshold
    is predicted 1. An empty table gives no rows; further columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        model = sent.value
        if not model or not len(texts):
            return pd.Series(np.zeros(len(texts)))
        x = np.array([features(t, model["lexicon"]) for t in texts], float)
        return pd.Series(calibrated(model["knots"], raw_scores(model["trees"], x)))

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored.asNondeterministic()(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return score(docs, fit(docs, read(spark, sf_dir, "labels")))
