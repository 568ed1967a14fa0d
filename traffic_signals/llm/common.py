"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as the contracts define it: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the cluster's own, or, with a local master only, a temporary one where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


#: The tables that the job in this context has staged; none outside of `own_tables`. Jobs in other threads have lists of their own.
_own: ContextVar[list[str] | None] = ContextVar("own_tables", default=None)


def table(df: DataFrame, name: str) -> str:
    """Write a table to the shared checkpoint folder; returns its path. It goes when the driver ends, if nobody deletes it before."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at, fs = _file(df.sparkSession, path)
    fs.deleteOnExit(at)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it again.

    This cuts the lineage: a lost executor costs a reread of Parquet, never the work before it.
    """
    path = table(df, name)
    own = _own.get()
    if own is not None:
        own.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, also after a failure. Nothing may read it any more then."""
    token = _own.set([])
    try:
        yield
    finally:
        own = _own.get() or []
        _own.reset(token)
        for path in own:
            delete_table(spark, path)


def delete_table(spark: SparkSession, path: str) -> None:
    at, fs = _file(spark, path)
    fs.delete(at, True)


def _file(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def held_out(doc_id: Column) -> Column:
    """Whether the document must not be learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def bounded(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """About `bound` rows (all, if there are fewer), picked by a hash of the key."""
    n = df.count()
    if n <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * (bound / n)))


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of about `bound` labelled documents outside the held-out fold.

    Only the sampled labels are broadcast, so the size of what is sent is bounded by the parameter.
    A document with several labels counts with the largest; labels other than 0 and 1 don't count.
    """
    picked = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("label"))
    picked = bounded(picked, F.col("doc_id"), bound).groupBy("doc_id").agg(F.max("label").alias("label"))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


class Hashes(dict):
    """64-bit hashes of words (bytes), computed once for each distinct word of a task."""

    LIMIT = 1 << 20

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lowered. bytes.lower and bytes.split know ASCII alone, as the contract asks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(tokens: list[bytes], hashes: Hashes) -> np.ndarray:
    return np.fromiter((hashes[w] for w in tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64 bits, so that sums of hashes don't keep any structure."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles, in order; with fewer words the whole sequence is one; without words none."""
    n = len(h)
    if n == 0:
        return np.empty(0, np.uint64)
    size = min(n, k)
    out = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        out = mixed(out * np.uint64(0xD1342543DE82EF95) + h[j : n - size + 1 + j])
    return out if n >= k else out + np.uint64(n)
