"""Operator 7: approximate nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised separately, so K centroids a half give K x K cells. A query walks the pairs of centroids in the
order of their summed distance (negative inner product) with a heap, and the entries of the visited cells are reranked by the exact
inner product.

How far a query walks is learned, not fixed: its 20th best score among a bounded sample of vectors is a lower bound of its 20th best
score among all, and a margin calibrated on the sample says how far below that score the centroid pair of a true neighbour may lie.

Equal vectors are collapsed first (no more than the 21 smallest ids of each can ever be returned), so a frequent vector costs no more
than a rare one. Cells are dealt over shards of bounded size, a large cell over several, and each shard meets its queries in blocks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, read, staged

NEAREST = 20
EVERY = 20  # ids divisible by this are queries
SAMPLE = 8000  # bound of the sample of distinct vectors that centroids and margin are fitted on
SHARD = 4096  # distinct vectors in a shard, about
QUERY_BLOCK = 20_000  # distinct queries that a shard meets at once, about
CAPTURE = 0.96  # share of the sample's true neighbours whose cells the margin must reach
MOST_CENTROIDS = 256


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): double vectors that take part; rows that are equal in both count once.

    Null ids, and vectors that are null, empty, zero or hold a null or non-finite component, take no part; nor do vectors whose length
    isn't the most frequent one (the shorter of equally frequent), as they have no inner product with the rest. All different vectors
    of an id are rows of their own.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    v = staged(v.where(F.forall("v", fine) & F.exists("v", lambda x: x != 0)).distinct(), "vectors")
    size = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("v") == (size["n"] if size else 0))


def k_means(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Centroids, seeded from spread rows; an empty cluster keeps its place."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(steps):
        near = ((c**2).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


class MultiIndex:
    """Centroids of both halves, the sample, and the margin of the walk."""

    def __init__(self, sample: np.ndarray, k: int, nearest: int = NEAREST, capture: float = CAPTURE):
        self.half, self.sample, self.nearest = sample.shape[1] // 2, sample, nearest
        self.left, self.right = k_means(sample[:, : self.half], k), k_means(sample[:, self.half :], k)
        self.margin = np.inf
        if len(sample) > 2 * nearest:
            q = np.linspace(0, len(sample) - 1, min(500, len(sample))).astype(int)
            scores = sample[q] @ sample.T
            scores[np.arange(len(q)), q] = -np.inf
            top = np.argpartition(-scores, nearest - 1, 1)[:, :nearest]
            floor = np.take_along_axis(scores, top, 1).min(1)
            i, j = self.cells(sample)
            middle = np.concatenate([self.left[i], self.right[j]], 1)
            gaps = floor[:, None] - np.einsum("qd,qnd->qn", sample[q], middle[top])
            self.margin = float(np.quantile(gaps, capture))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = lambda part, c: ((c**2).sum(1) - 2 * part @ c.T).argmin(1)
        return near(x[:, : self.half], self.left), near(x[:, self.half :], self.right)

    def cell(self, x: np.ndarray) -> np.ndarray:
        i, j = self.cells(x)
        return i * len(self.right) + j

    def walks(self, queries: np.ndarray, counts: np.ndarray) -> Iterator[list[int]]:
        """The non-empty cells that each query visits, nearest first."""
        need = self.nearest + 1
        scores = queries @ self.sample.T
        enough = len(self.sample) > need
        # The query itself may be in the sample: one place more.
        floor = -np.partition(-scores, need - 1, 1)[:, need - 1] if enough else np.full(len(queries), -np.inf)
        a, b = -queries[:, : self.half] @ self.left.T, -queries[:, self.half :] @ self.right.T
        order_a, order_b = a.argsort(1, "stable"), b.argsort(1, "stable")
        for n in range(len(queries)):
            oa, ob = order_a[n].tolist(), order_b[n].tolist()
            da, db = a[n][order_a[n]].tolist(), b[n][order_b[n]].tolist()
            last = self.margin - floor[n]
            heap, seen, found, visited = [(da[0] + db[0], 0, 0)], 0, [], [0] * len(oa)
            while heap:
                d, i, j = heapq.heappop(heap)
                if d > last and seen >= need:
                    break
                cell = oa[i] * len(self.right) + ob[j]
                if counts[cell]:
                    found.append(cell)
                    seen += counts[cell]
                visited[i] = j + 1
                if j + 1 < len(ob) and (i == 0 or visited[i - 1] > j + 1):
                    heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
                if i + 1 < len(oa) and visited[i + 1] == j:
                    heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
            yield found


def reranked(key: tuple, entries: pd.DataFrame, asked: pd.DataFrame, need: int) -> pd.DataFrame:
    """The best `need` ids of a shard for each query, by exact inner product among the cells that the query visits.

    A matrix product tells which entries can be among them, with room for its rounding; their scores are then summed exactly and
    rounded once, so that they depend neither on blocks nor on the order of the components.
    """
    columns = ["query", "vec_id", "vid", "score"]
    if not len(entries) or not len(asked):
        return pd.DataFrame({c: [] for c in columns})
    x, cells = np.array(entries["v"].tolist()), entries["cell"].to_numpy()
    names, local = np.unique(cells, return_inverse=True)
    ids, vids, norms = entries["ids"].tolist(), entries["vid"].to_numpy(), np.linalg.norm(x, axis=1)
    out = []
    for at in range(0, len(asked), 512):
        part = asked.iloc[at : at + 512]
        visits = np.zeros((len(part), len(names)), bool)
        for n, own in enumerate(part["cells"]):
            visits[n, np.searchsorted(names, own[np.isin(own, names)] if isinstance(own, np.ndarray) else [c for c in own if c in names])] = True
        asking = np.array(part["v"].tolist())
        s = asking @ x.T
        s[~visits[:, local]] = -np.inf
        room = 1e-12 * np.linalg.norm(asking, axis=1) * norms.max()
        least = -np.partition(-s, need - 1, 1)[:, need - 1] - room if s.shape[1] > need else np.full(len(s), -np.inf)
        q, e = np.nonzero((s >= least[:, None]) & (s > -np.inf))
        exact = np.array([math.fsum(row) for row in asking[q] * x[e]])
        n = np.array([len(ids[k]) for k in e], int)
        q, score, own = np.repeat(q, n), np.repeat(exact, n), np.repeat(vids[e], n)
        vec = np.concatenate([ids[k] for k in e]) if len(e) else np.empty(0, np.int64)
        order = np.lexsort((vec, -score, q))
        order = order[np.arange(len(q)) - np.searchsorted(q[order], q[order]) < need]
        out.append(pd.DataFrame({"query": part["vid"].to_numpy()[q[order]], "vec_id": vec[order], "vid": own[order], "score": score[order]}))
    return pd.concat(out)


def search(vectors: DataFrame, every: int = EVERY, nearest: int = NEAREST, sample: int = SAMPLE, centroids: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for each row whose id is divisible by `every`, its own row apart.

    Nearest is the largest inner product in double precision; ties go to the smaller vec_id. Repeated rows count once (`usable` says
    which rows take part); an id with several vectors asks with each, and each of them is a candidate. A table with no usable query
    gives no rows; a query without another usable row has none. Without enough vectors to calibrate on, all cells are visited.
    Further columns are not read. A task holds a shard of about SHARD distinct vectors and 512 queries at a time, so vectors may be
    long as far as that many fit.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    need = nearest + 1
    place = Window.partitionBy("v").orderBy("vec_id")
    distinct = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= need).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = staged(distinct.select(F.monotonically_increasing_id().alias("vid"), "ids", "v"), "distinct-vectors")
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = np.array([r["v"] for r in bounded(distinct, F.xxhash64("v"), sample).select("v").orderBy("v").collect()] or [distinct.first()["v"]])
    index = MultiIndex(fitted, centroids or int(min(MOST_CENTROIDS, max(4, round(n**0.5 / 7)))), nearest)
    sent = spark.sparkContext.broadcast(index)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(cell=sent.value.cell(np.array(pdf["v"].tolist())) if len(pdf) else 0)

    entries = staged(distinct.mapInPandas(placed, "vid long, ids array<long>, v array<double>, cell int"), "entries")
    counts = np.zeros(len(index.left) * len(index.right), np.int64)
    for r in entries.groupBy("cell").agg(F.sum(F.size("ids")).alias("n"), F.count("*").alias("d")).collect():  # K x K rows at most
        counts[r["cell"]] = r["n"]
    # Cells to shards: consecutive small cells share one, a large one is dealt over several by a hash of the id.
    first, pieces, shard, load = np.zeros(len(counts), int), np.ones(len(counts), int), 0, 0
    for c, size in enumerate(counts):
        if load and load + size > SHARD:
            shard, load = shard + 1, 0
        first[c], pieces[c] = shard, max(1, -(-int(size) // SHARD))
        shard, load = shard + pieces[c] - 1, load + int(size) if pieces[c] == 1 else SHARD
    plan = spark.sparkContext.broadcast((counts, first, pieces))

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, first, pieces = plan.value
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part, out = pdf.iloc[at : at + 512], []
                for vid, v, cells in zip(part["vid"], part["v"], sent.value.walks(np.array(part["v"].tolist()), counts), strict=True):
                    by: dict[int, list[int]] = {}
                    for c in cells:
                        for k in range(pieces[c]):
                            by.setdefault(int(first[c]) + k, []).append(c)
                    out += [(vid, v, k, own) for k, own in by.items()]
                yield pd.DataFrame(out, columns=["vid", "v", "shard", "cells"])

    def sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, first, pieces = plan.value
        for pdf in batches:
            c = pdf["cell"].to_numpy()
            yield pdf.assign(shard=first[c] + (pdf["vid"].to_numpy() * 0x9E3779B1 >> 16) % pieces[c])

    asked = queries.select("v").distinct().join(distinct, "v").select("vid", "v")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.mapInPandas(walked, "vid long, v array<double>, shard int, cells array<int>").withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(blocks)))
    held = entries.mapInPandas(sharded, "vid long, ids array<long>, v array<double>, cell int, shard int").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    met = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    found = met.applyInPandas(lambda key, e, q: reranked(key, e, q, need), "query long, vec_id long, vid long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "vid")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= need)
    found = found.groupBy(F.col("query").alias("q_vid")).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "vid"))).alias("found"))
    named = queries.join(distinct.select("vid", "v"), "v").select("query_id", "vid").join(found, F.col("vid") == F.col("q_vid"))
    listed = F.slice(F.filter("found", lambda f: (f.vec_id != F.col("query_id")) | (f.vid != F.col("vid"))), 1, nearest)
    return named.select("query_id", F.posexplode(listed).alias("at", "f")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "f.vec_id", "f.score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"))
