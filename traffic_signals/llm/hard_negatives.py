"""Operator 13: hard negatives by an inverted multi-index with certified bounds.

Vectors of whole numbers are quantised in two halves, so K centroids a half give K x K cells. A half-space centroid has a radius, the
largest distance of a row to it; so the score of any row of a cell is at most the sum of two half-scores, each the centroid's inner
product with the query's half plus radius times the half's length. A query walks the cells in the order of that sum with a heap and
stops as soon as it is below everything that may still be wanted. What may be wanted is certified by a bounded sample of rows: a row of
the sample that would be returned is a lower limit for the last one that is. The result is therefore exact, whatever the centroids are.

Two walks: one for the positives, the other, with their scores, for the windows of negatives. Cells are dealt over shards of bounded
size and queries over blocks of like ones; a shard is sent to a block only if one of its queries visits it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, read, staged
from .neighbours import k_means

POSITIVES = 5
NEGATIVES = 5
EVERY = 100  # ids divisible by this are anchors
LOW, HIGH = 80, 100  # LOW * positive <= HIGH * negative <= HIGH * positive
SCALE = 256
MOST = 1 << 24  # scaled components are smaller, so that scores, and HIGH times them, fit 64 bits
SAMPLE = 8000  # bound of the sample of distinct rows that centroids are fitted on and windows certified with
MOST_CENTROIDS = 256
SHARD = 16_384  # distinct rows in a shard, about
BLOCK = 4096  # distinct queries in a block, about
TOGETHER = 256  # queries that are scored at once


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): rows that take part, their components scaled and rounded down; rows that are equal in all three count once.

    Null ids and labels take no part, nor do vectors that are null, empty, or hold a null or non-finite component or one that is MOST
    or more after scaling, nor vectors whose length isn't the most frequent one (the shorter of equally frequent).
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(MOST / scale))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", fine))
    rows = staged(rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v")).distinct(), "labelled-vectors")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


class BoundedIndex:
    """Centroids of both halves with their radii, and the sample that windows are certified with."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, k: int):
        self.half, self.vectors, self.labels = vectors.shape[1] // 2, vectors, labels
        self.centres = (k_means(vectors[:, : self.half], k), k_means(vectors[:, self.half :], k))
        self.radii = (np.zeros(len(self.centres[0])), np.zeros(len(self.centres[1])))

    def placed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Centroids of both halves of each row, and the distances to them."""
        out: list[np.ndarray] = []
        for part, c in zip((x[:, : self.half], x[:, self.half :]), self.centres, strict=True):
            near = ((c**2).sum(1) - 2 * part @ c.T).argmin(1)
            out += [near, np.sqrt(((part - c[near]) ** 2).sum(1))]
        return out[0], out[2], out[1], out[3]

    def walk(self, query: np.ndarray, least: float) -> Iterator[tuple[int, int]]:
        """Pairs of centroids by falling bound on the score of their rows, as long as it isn't below `least`."""
        bounds = []
        for part, c, r in zip((query[: self.half], query[self.half :]), self.centres, self.radii, strict=True):
            b = c @ part + r * np.linalg.norm(part)
            bounds.append(b + 1e-9 * (1 + np.abs(b)))  # room for rounding
        a, b = (np.sort(-x, kind="stable") for x in bounds)
        left, right = ((-x).argsort(kind="stable").tolist() for x in bounds)
        a, b = a.tolist(), b.tolist()
        heap, reached = [(a[0] + b[0], 0, 0)], [0] * len(a)
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < least:
                return
            yield left[i], right[j]
            reached[i] = j + 1
            if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(a) and reached[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))

    def positive_floor(self, queries: np.ndarray, labels: np.ndarray, need: int) -> np.ndarray:
        """A score that the `need`-th best row of the same label has at least; 0 where the sample can't tell, as no window lies below it."""
        s = product(queries, self.vectors)
        s = np.where(labels[:, None] == self.labels, s, -1)
        return np.maximum(0, -np.partition(-s, need - 1, 1)[:, need - 1]) if s.shape[1] >= need else np.zeros(len(queries), np.int64)

    def window_floors(self, query: np.ndarray, label: int, positives: np.ndarray, need: int, low: int, high: int) -> np.ndarray:
        """For each positive's score, one that the last negative in its window has at least: that of the `need`-th of the sample, or the window's end."""
        s = np.sort(product(query[None], self.vectors)[0][self.labels != label])
        at = np.searchsorted(s, positives, "right") - need
        ends = -(-low * positives // high)
        return np.maximum(ends, np.where(at >= 0, s[np.maximum(at, 0)], 0)) if len(s) else ends


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b: in doubles where no sum can reach 2^53, else in 64-bit integers."""
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if most < 2**53 else a.astype(np.int64) @ b.T.astype(np.int64)


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64)


class Dealing:
    """Numbered cells over bins of about `size` rows: consecutive small cells share one, a large one is dealt over several."""

    def __init__(self, counts: np.ndarray, size: int):
        self.first, self.pieces = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        at, load = 0, 0
        for c in np.flatnonzero(counts).tolist():
            n = int(counts[c])
            if load and load + n > size:
                at, load = at + 1, 0
            self.first[c], self.pieces[c] = at, max(1, -(-n // size))
            at, load = at + int(self.pieces[c]) - 1, load + n if self.pieces[c] == 1 else size
        self.filled = counts > 0

    def bins(self, cells: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return self.first[cells] + (salt * 0x9E3779B1 >> 16) % self.pieces[cells]


def cell_counts(rows: DataFrame, cells: int) -> np.ndarray:
    """Rows in each cell; there are MOST_CENTROIDS squared cells at most."""
    out = np.zeros(cells, np.int64)
    for r in rows.groupBy("cell").count().collect():
        out[r["cell"]] = r["count"]
    return out


def visited(queries: DataFrame, index: Broadcast, shards: Broadcast) -> DataFrame:
    """(gid, block, shard): the shards of the cells that each query (gid, v, block, least) walks through."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dealt, right = shards.value, len(index.value.centres[1])
        for pdf in batches:
            out = []
            for gid, v, block, least in zip(pdf["gid"], pdf["v"], pdf["block"], pdf["least"], strict=True):
                seen: set[int] = set()
                for i, j in index.value.walk(np.asarray(v, float), least):
                    if dealt.filled[c := i * right + j]:
                        seen.update(range(int(dealt.first[c]), int(dealt.first[c] + dealt.pieces[c])))
                out += [(gid, block, s) for s in seen]
            yield pd.DataFrame(out, columns=["gid", "block", "shard"])

    return staged(queries.select("gid", "v", "block", "least").mapInPandas(run, "gid long, block long, shard long"), "visits")


def met(entries: DataFrame, queries: DataFrame, visits: DataFrame, scored, columns: str) -> DataFrame:
    """scored(entries, queries) for each shard and block of queries that visit it."""
    asked = queries.drop("block").join(visits, "gid")
    wanted = visits.select("shard", F.col("block").alias("to")).distinct()
    return entries.join(wanted, "shard").groupBy("shard", "to").cogroup(asked.groupBy("shard", "block")).applyInPandas(scored, columns)


def ranked(parts: np.ndarray, scores: np.ndarray, entry: np.ndarray, ids: list, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, id, score, entry): for each part, the `need` best ids of its entries, the greatest score first, of equal ones the smallest id."""
    n = np.array([len(ids[e]) for e in entry.tolist()], np.int64)
    part, score, own = np.repeat(parts, n), np.repeat(scores, n), np.repeat(entry, n)
    vec = np.concatenate([ids[e] for e in entry.tolist()]) if len(entry) else np.empty(0, np.int64)
    order = np.lexsort((vec, -score, part))
    order = order[np.arange(len(order)) - np.searchsorted(part[order], part[order]) < need]
    return part[order], vec[order], score[order], own[order]


def best_positives(entries: pd.DataFrame, asked: pd.DataFrame, need: int) -> pd.DataFrame:
    """Of a shard, the `need` best ids of each query's own label that reach its floor."""
    columns, out = ["gid", "vec_id", "score", "own"], []
    if len(entries) and len(asked):
        x, labels, ids, gids = matrix(entries["v"]), entries["label"].to_numpy(), entries["ids"].tolist(), entries["gid"].to_numpy()
        for at in range(0, len(asked), TOGETHER):
            part = asked.iloc[at : at + TOGETHER]
            s = product(matrix(part["v"]), x)
            q, e = np.nonzero((s >= part["least"].to_numpy()[:, None]) & (part["label"].to_numpy()[:, None] == labels))
            q, vec, score, e = ranked(q, s[q, e], e, ids, need)
            gid = part["gid"].to_numpy()[q]
            out.append(pd.DataFrame({"gid": gid, "vec_id": vec, "score": score, "own": gid == gids[e]}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns})


def best_negatives(entries: pd.DataFrame, asked: pd.DataFrame, need: int) -> pd.DataFrame:
    """Of a shard, the `need` best ids of other labels in the window of each of a query's positive scores."""
    columns, out = ["gid", "positive_score", "vec_id", "score"], []
    if len(entries) and len(asked):
        x, labels, ids = matrix(entries["v"]), entries["label"].to_numpy(), entries["ids"].tolist()
        for at in range(0, len(asked), TOGETHER):
            part = asked.iloc[at : at + TOGETHER]
            s = product(matrix(part["v"]), x)
            s[part["label"].to_numpy()[:, None] == labels] = -1  # windows begin at 0
            most = max(map(len, part["windows"]), default=0)
            for k in range(most):
                has = np.array([k < len(w) for w in part["windows"]])
                low = np.array([w[k]["least"] if k < len(w) else 0 for w in part["windows"]], np.int64)
                high = np.array([w[k]["score"] if k < len(w) else -1 for w in part["windows"]], np.int64)
                q, e = np.nonzero((s >= low[:, None]) & (s <= high[:, None]) & has[:, None])
                q, vec, score, _ = ranked(q, s[q, e], e, ids, need)
                out.append(pd.DataFrame({"gid": part["gid"].to_numpy()[q], "positive_score": high[q], "vec_id": vec, "score": score}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns})


def _first(found: DataFrame, need: int, *keys: str) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= need)


def mine(rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE, centroids: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: what `usable` gives (vec_id, label, v of whole numbers), staged. Anchors are the rows whose id is divisible by `every`; the
    positives of one are its first `positives` other rows of its label by integer inner product, of equal ones the smaller id; for each
    the first `negatives` rows of other labels whose score is in its window are returned. A positive with a score below 0 has an empty
    window. An id with several vectors or labels is a row for each. A table without anchors, or without rows of other labels, gives no rows.

    Rows that are equal in label and vector are one entry with their smallest ids, more of which can't be returned, and anchors that are
    equal in both are one query; so a frequent vector costs no more than a rare one.
    """
    spark, need = rows.sparkSession, positives + 1  # the anchor itself may be among them
    kept = max(need, negatives)
    place = Window.partitionBy("label", "v").orderBy("vec_id")
    entries = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= kept).groupBy("label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    anchors = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    entries = staged(entries.select(F.monotonically_increasing_id().alias("gid"), "label", "v", "ids"), "entries")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    fitted = bounded(entries, F.xxhash64("label", "v"), sample).select("v", "label").orderBy("v", "label").collect() or entries.select("v", "label").take(1)
    k = centroids or int(min(MOST_CENTROIDS, max(2, round(n**0.5 / 7))))
    plain = BoundedIndex(np.array([r["v"] for r in fitted], np.int64), np.array([r["label"] for r in fitted], np.int64), k)
    fit = spark.sparkContext.broadcast(plain)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                i, j, di, dj = fit.value.placed(matrix(pdf["v"]).astype(float))
                yield pdf.assign(i=i, j=j, di=di, dj=dj, cell=i * len(fit.value.centres[1]) + j)

    entries = staged(entries.mapInPandas(placed, "gid long, label long, v array<int>, ids array<long>, i int, j int, di double, dj double, cell int"), "entries-in-cells")
    for half, (c, d) in enumerate((("i", "di"), ("j", "dj"))):
        for r in entries.groupBy(c).agg(F.max(d).alias("radius")).collect():  # a row a centroid
            plain.radii[half][r[c]] = r["radius"] * (1 + 1e-9) + 1e-9
    index = spark.sparkContext.broadcast(plain)  # with radii
    cells = len(plain.radii[0]) * len(plain.radii[1])
    asked = anchors.select("label", "v").distinct().join(entries.select("gid", "label", "v", "cell"), ["label", "v"])
    shards = spark.sparkContext.broadcast(Dealing(cell_counts(entries, cells), SHARD))
    blocks = spark.sparkContext.broadcast(Dealing(cell_counts(asked, cells), BLOCK))

    def dealt(column: str, to: Broadcast):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(**{column: to.value.bins(pdf["cell"].to_numpy(), pdf["gid"].to_numpy())})

        return run

    def floored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            least = [np.empty(0, np.int64)]
            for at in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[at : at + TOGETHER]
                least.append(index.value.positive_floor(matrix(part["v"]), part["label"].to_numpy(), need))
            yield pdf.assign(least=np.concatenate(least))

    def windowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            windows = []
            for v, label, scores in zip(pdf["v"], pdf["label"], pdf["scores"], strict=True):
                p = np.asarray(scores, np.int64)
                floors = index.value.window_floors(np.asarray(v, np.int64), label, p, negatives, low, high)
                windows.append([{"score": a, "least": b} for a, b in zip(p.tolist(), floors.tolist(), strict=True)])
            yield pdf.drop(columns="scores").assign(windows=windows, least=[min(w["least"] for w in own) for own in windows])

    held = entries.select("gid", "label", "v", "ids", "cell").mapInPandas(dealt("shard", shards), "gid long, label long, v array<int>, ids array<long>, cell int, shard long")
    held = staged(held.drop("cell"), "shards")
    queries = asked.mapInPandas(dealt("block", blocks), "label long, v array<int>, gid long, cell int, block long").drop("cell")
    queries = staged(queries.mapInPandas(floored, "label long, v array<int>, gid long, block long, least long"), "queries")
    near = met(held, queries, visited(queries, index, shards), lambda e, q: best_positives(e, q, need), "gid long, vec_id long, score long, own boolean")
    near = _first(near, need, "gid").groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("positives"))
    near = staged(near, "positives")
    scores = F.array_distinct(F.transform("positives", lambda p: p["score"]))
    second = queries.drop("least").join(near.select("gid", scores.alias("scores")), "gid")
    second = staged(second.select("label", "v", "gid", "block", "scores").mapInPandas(windowed, "label long, v array<int>, gid long, block long, windows array<struct<score: long, least: long>>, least long"), "windows")
    far = met(held, second, visited(second, index, shards), lambda e, q: best_negatives(e, q, negatives), "gid long, positive_score long, vec_id long, score long")
    far = _first(far, negatives, "gid", "positive_score").groupBy("gid", "positive_score").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    far = far.groupBy("gid").agg(F.collect_list(F.struct("positive_score", "found")).alias("windows"))  # a window a positive
    known = near.join(far, "gid").join(queries.select("gid", "label", "v"), "gid")
    # The own row takes no place among an anchor's positives.
    other = lambda p: ~p["own"] | (p["vec_id"] != F.col("anchor_id"))
    each = anchors.join(known, ["label", "v"]).select("anchor_id", "windows", F.explode(F.slice(F.filter("positives", other), 1, positives)).alias("p"))
    own = F.get(F.filter("windows", lambda w: w["positive_score"] == F.col("p.score")), F.lit(0))["found"]
    each = each.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"), F.explode(own).alias("f"))
    return each.select("anchor_id", "positive_id", F.col("f.place").alias("rank"), F.col("f.vec_id").alias("negative_id"), "positive_score", F.col("f.score").alias("negative_score"))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def moved_labels(vec_id: Column, label: Column) -> Column:
    """Labels, of which those of every seventh id are one further, modulo 10."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return mine(usable(vectors.select("vec_id", moved_labels(F.col("vec_id"), F.col("label").cast("long")).alias("label"), "embedding")))


SQL = """
WITH rows AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x::DOUBLE) < 65536)) = len(embedding)
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
