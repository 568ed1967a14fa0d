"""Operator 4: language identification by multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language are summed in Spark; the matrix of log-probabilities (buckets x languages, of bounded size) is broadcast,
and batches of whole texts, as sparse rows of n-gram buckets, are multiplied with it in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, held_out, mixed, read

UNDETERMINED = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_DOCUMENTS = 20_000  # bound of the sample that the model is fitted on
MATRIX_CELLS = 1 << 23  # bound of buckets times languages; with more than 256 languages there are fewer buckets
CHUNK = 1 << 17  # characters whose n-grams are hashed and scored at once


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Grams:
    """Hashed n-grams of a batch of whole texts, as blocks of a sparse matrix: bucket indexes, and where each text's begin.

    A text longer than CHUNK goes on in the next block, so a long text needs no more memory than a short one.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets

    def blocks(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
        """(texts of the block, bucket of each n-gram for each order, starts of the texts); where a window leaves its text the bucket
        is one more than there are."""
        own, parts, size = [], [], 0
        for i, text in enumerate(texts):
            points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
            for at in range(0, len(points), CHUNK):
                part = points[at : at + CHUNK + max(ORDERS) - 1]
                own.append(i)
                parts.append(part)
                size += len(part)
                if size >= CHUNK:
                    yield self._hashed(own, parts)
                    own, parts, size = [], [], 0
        if own:
            yield self._hashed(own, parts)

    def _hashed(self, own: list[int], parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        size = np.array([len(p) for p in parts])
        starts = np.cumsum(size) - size
        points = np.concatenate(parts).astype(np.uint64)
        left = np.repeat(size, size) - (np.arange(len(points)) - np.repeat(starts, size))  # characters up to the end of the piece
        begins = np.arange(len(points)) - np.repeat(starts, size) < CHUNK
        out = []
        for n in ORDERS:
            h = np.full(len(points), n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3)
                h[: len(points) - j] += points[j:]
            bucket = (mixed(h) % np.uint64(self.buckets)).astype(np.int64)
            bucket[(left < n) | ~begins] = self.buckets
            out.append(bucket)
        return np.array(own), out, starts


def counted(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """Counts of buckets by language, one row for each that occurs in the task."""
    totals: dict[str, np.ndarray] = {}
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            row = totals.setdefault(lang, np.zeros(buckets, np.int64))
            for _, grams, _ in Grams(buckets).blocks(texts.tolist()):
                for bucket in grams:
                    row += np.bincount(bucket, minlength=buckets + 1)[:buckets]
    for lang, row in totals.items():
        some = np.flatnonzero(row)
        yield pd.DataFrame({"lang": lang, "bucket": some, "n": row[some]})


def fit(docs: DataFrame, buckets: int = BUCKETS, bound: int = TRAIN_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (buckets + 1 x languages; the last row holds the log-priors), from documents with a
    text and a lang outside the held-out fold. Without any such document there are no languages. The matrix is broadcast and has at
    most MATRIX_CELLS cells, whatever the number of languages."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = bounded(rows, F.col("doc_id"), bound)
    priors = dict(rows.groupBy("lang").count().collect())  # `bound` languages at most
    langs = sorted(priors)
    buckets = min(buckets, max(1, MATRIX_CELLS // max(1, len(langs))))
    sums = rows.select("text", "lang").mapInPandas(lambda it: counted(it, buckets), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = sums.where(F.col("n") > 0).toPandas()  # MATRIX_CELLS rows at most
    counts = np.full((buckets, len(langs)), 0.5)
    place = {x: i for i, x in enumerate(langs)}
    counts[sums["bucket"].to_numpy(int), np.array([place[x] for x in sums["lang"]], int)] += sums["n"].to_numpy(float)
    logs = np.log(counts) - np.log(counts.sum(axis=0))
    return langs, np.vstack([logs, np.log(np.array([priors[x] for x in langs], float).reshape(1, -1) / max(1, sum(priors.values())))])


def log_scores(texts: list[str], logs: np.ndarray) -> np.ndarray:
    """Log-prior plus the sum of log-probabilities of all n-grams, for each text and language: sparse rows of counts times the matrix."""
    total = np.tile(logs[-1], (len(texts), 1))
    buckets = len(logs) - 1
    rows = np.vstack([logs[:-1], np.zeros((1, logs.shape[1]))])
    step = max(1, (1 << 22) // max(1, logs.shape[1]))
    for own, grams, starts in Grams(buckets).blocks(texts):
        for at in range(0, len(grams[0]), step):  # bounded, however many languages there are
            lo = max(0, np.searchsorted(starts, at, "right") - 1)
            hi = np.searchsorted(starts, at + step, "left")
            values = sum(rows[bucket[at : at + step]] for bucket in grams)
            np.add.at(total, own[lo:hi], np.add.reduceat(values, np.maximum(starts[lo:hi] - at, 0), axis=0))
    return total


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs (doc_id, text).

    score is the posterior of the predicted language. A text that is null or has no letter is `und` with score 0, as is everything
    if there was nothing to learn from. Ties go to the language first in code point order. Texts of any length are read whole; a
    null doc_id counts as held out; repeated rows are predicted each, and alike. An empty table gives no rows; further columns are
    not read.
    """
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        langs, logs = model.value
        out = pd.DataFrame({"lang_pred": UNDETERMINED, "score": np.zeros(len(texts))})
        known = [i for i, t in enumerate(texts) if langs and t is not None and has_letter(t)]
        if known:
            s = log_scores([texts.iat[i] for i in known], logs)
            out.loc[known, "lang_pred"] = np.array(langs, object)[s.argmax(1)]
            out.loc[known, "score"] = 1 / np.exp(s - s.max(1, keepdims=True)).sum(1)
        return out

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored.asNondeterministic()(F.col("text")).alias("s"))
    return rows.select("doc_id", "held_out", "s.lang_pred", "s.score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, *fit(docs))
