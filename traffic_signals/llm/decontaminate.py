"""Operator 3: benchmark decontamination by greedy string tiling.

Word seeds of the benchmark form an inverted index, which documents meet inside their own scan. For the items that share enough seeds
with a document, running Karp-Rabin matching marks the longest non-overlapping matches again and again. The share of an item's words
under tiles is its coverage, which does not depend on the order of the passages in the document.

The index of a benchmark of at most `block_words` words (counted in Spark) is broadcast once, and nothing is shuffled. A larger one is
dealt over blocks of about that size, and one block at a time is on the driver and broadcast: first to note the hashes of the seeds in
a bitmap of fixed size, by which one scan sets apart the documents that share any seed; then these documents meet block after block.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, read, shingles, staged

TOKEN = re.compile(r"[^\W_]+")
MIN_MATCH = 5  # words of the shortest tile, and of a seed; an item of fewer words is matched whole
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000  # words of the benchmark in one broadcast
FILTER_BITS = 1 << 26  # of the bitmap of seeds for a benchmark of several blocks
MASK = np.uint64((1 << 16) - 1)
LEAKS = "array<struct<item_id:long,coverage:double,tiles:int,words:array<array<int>>>>"


def token_hashes(text: str | None, hashes: Hashes) -> np.ndarray:
    found = TOKEN.findall((text or "").lower())
    return np.fromiter((hashes[w] for w in found), np.uint64, len(found))


class Hashed(Hashes):
    """Hashes of str words."""

    def __missing__(self, word: str) -> int:
        h = super().__missing__(word.encode("utf-8", "surrogatepass"))
        del self[word.encode("utf-8", "surrogatepass")]
        self[word] = h
        return h


def tiles(a: list[int], b: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of pattern a and text b by running Karp-Rabin: (start in a, start in b, length), longest first.

    Ties go to the match that starts first in a, then in b. Marked words take no part in later matches; of a match that is partly
    marked the free pieces stay in the running.
    """
    marked_a, marked_b = [False] * len(a), [False] * len(b)
    out: list[tuple[int, int, int]] = []

    def windows(x: list[int], marked: list[bool], s: int) -> Iterator[tuple[int, int]]:
        """(start, rolling hash) of the windows of s unmarked words."""
        base, mod = 1_000_003, (1 << 61) - 1
        top, h, run = pow(base, s, mod), 0, 0
        for i, v in enumerate(x):
            run = 0 if marked[i] else run + 1
            h = (h * base + v) % mod
            if i >= s:
                h = (h - x[i - s] * top) % mod
            if run >= s:
                yield i - s + 1, h

    def free(i: int, j: int) -> bool:
        return not marked_a[i] and not marked_b[j]

    def free_pieces(i: int, j: int, n: int) -> list[tuple[int, int]]:
        """(offset, length) of the parts of a match that are not marked."""
        edges = np.flatnonzero(np.diff([False, *(free(i + k, j + k) for k in range(n)), False]))
        return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))

    s = max(least, min(len(a), len(b)))
    while s >= least:
        table: dict[int, list[int]] = {}
        for i, h in windows(a, marked_a, s):
            table.setdefault(h, []).append(i)
        heap: list[tuple[int, int, int]] = []
        for j, h in windows(b, marked_b, s):
            for i in table.get(h, ()):
                if i and j and a[i - 1] == b[j - 1] and free(i - 1, j - 1):
                    continue  # inside the match that starts one word before
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free(i + n, j + n):
                    n += 1
                if n >= s:
                    heap.append((-n, i, j))
        heapq.heapify(heap)
        while heap:
            n, i, j = heapq.heappop(heap)
            pieces = free_pieces(i, j, -n)
            if pieces == [(0, -n)]:
                marked_a[i : i - n] = marked_b[j : j - n] = [True] * -n
                out.append((i, j, -n))
                continue
            for at, length in pieces:
                if length >= s:  # shorter ones are found by shorter windows
                    heapq.heappush(heap, (-length, i + at, j + at))
        s = max(least, s // 2) if s > least else 0
    return out


class Index:
    """The seeds of a block of benchmark items: sorted seed hashes with their items and positions; short items by their length."""

    def __init__(self, items: list[tuple[int, np.ndarray]], least: int):
        self.items = [x for x in items if len(x[1]) >= least]
        self.size = np.array([len(h) for _, h in self.items], np.int64)
        seeds = [shingles(h, least) for _, h in self.items]
        self.seed = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        self.item = np.repeat(np.arange(len(self.items)), [len(s) for s in seeds])
        self.at = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.empty(0, np.int64)
        order = np.argsort(self.seed, kind="stable")
        self.seed, self.item, self.at = self.seed[order], self.item[order], self.at[order]
        self.some = np.zeros(1 << 16, bool)
        self.some[self.seed & MASK] = True
        self.short: dict[int, dict[int, list[int]]] = {}
        for item_id, h in items:
            if 0 < len(h) < least:
                self.short.setdefault(len(h), {}).setdefault(int(shingles(h, len(h))[0]), []).append(item_id)

    def hashes(self) -> dict[int, np.ndarray]:
        """By number of words, the hashes of all seeds and of all short items."""
        return {n: np.array(list(own), np.uint64) for n, own in self.short.items()} | {0: self.seed}


def contaminations(h: np.ndarray, index: Index, least: int, coverage: float) -> list[dict]:
    """The items whose tiles in a document (its word hashes) cover enough of them, with word spans of the tiles."""
    out = []
    for n, own in sorted(index.short.items()):
        if len(h) >= n:
            values, first = np.unique(shingles(h, n), return_index=True)
            for k in np.flatnonzero(np.isin(values, np.array(list(own), np.uint64))).tolist():
                out += [{"item_id": i, "coverage": 1.0, "tiles": 1, "words": [[int(first[k]), int(first[k]) + n]]} for i in own[int(values[k])]]
    if len(h) < least or not len(index.seed):
        return out
    seeds = shingles(h, least)
    where = np.flatnonzero(index.some[seeds & MASK])
    lo, hi = np.searchsorted(index.seed, seeds[where], "left"), np.searchsorted(index.seed, seeds[where], "right")
    where, lo, hi = where[hi > lo], lo[hi > lo], hi[hi > lo]
    if not len(where):
        return out
    # The entries of each different shared seed once, and from them the words of each item under a shared seed.
    own, one = np.unique(lo, return_index=True)
    n = hi[one] - own
    entry = np.repeat(own, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    items, nth = np.unique(index.item[entry], return_inverse=True)
    size = index.size[items]
    base = np.cumsum(size) - size
    marks = np.zeros(size.sum() + 1, np.int64)
    np.add.at(marks, base[nth] + index.at[entry], 1)
    np.add.at(marks, base[nth] + index.at[entry] + least, -1)
    # A seed that ends an item closes at the next one's start, where it cancels nothing of that item's own.
    share = np.add.reduceat(np.cumsum(marks[:-1]) > 0, base) / size
    by_item = np.split(np.repeat(own, n)[np.argsort(nth, kind="stable")], np.cumsum(np.bincount(nth))[:-1])
    order = np.argsort(lo, kind="stable")
    ranked = lo[order]
    for k in np.flatnonzero(share >= coverage).tolist():  # tiles are made of shared seeds, so they can't cover more
        item_id, pattern = index.items[items[k]]
        # Only words under a shared seed can be in a tile; a gap of one impossible word keeps the pieces apart.
        a, b = np.searchsorted(ranked, by_item[k], "left"), np.searchsorted(ranked, by_item[k], "right")
        at = where[order[np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)]]
        spots = np.unique(at[:, None] + np.arange(least))
        text: list[int] = []
        place: list[int] = []
        for piece in np.split(spots, np.flatnonzero(np.diff(spots) > 1) + 1):
            text += [*(int(v) >> 3 for v in h[piece]), -1 - len(text)]
            place += [*piece.tolist(), -1]
        got = tiles([int(v) >> 3 for v in pattern], text, least)
        covered = sum(n for _, _, n in got) / len(pattern)
        if covered >= coverage:
            spans = sorted((place[j], place[j] + n) for _, j, n in got)
            out.append({"item_id": item_id, "coverage": covered, "tiles": len(got), "words": [list(s) for s in spans]})
    return out


def usable(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())


def n_blocks(items: DataFrame, block_words: int) -> int:
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")))).first()[0] or 0
    return max(1, -(-words // block_words))


def index_of(items: DataFrame, least: int) -> Index:
    hashes = Hashed()
    return Index([(r["item_id"], token_hashes(r["text"], hashes)) for r in items.orderBy("item_id", "text").toLocalIterator()], least)


def leaks(spark: SparkSession, index: Index, least: int, coverage: float) -> Column:
    """The entries of one index in the column text."""
    sent = spark.sparkContext.broadcast(index)

    @F.pandas_udf(LEAKS)
    def found(texts: pd.Series) -> pd.Series:
        hashes = Hashed()
        return pd.Series([contaminations(token_hashes(t, hashes), sent.value, least, coverage) for t in texts], dtype=object)

    return found.asNondeterministic()(F.col("text"))


def sharing(docs: DataFrame, items: DataFrame, blocks: int, least: int) -> DataFrame:
    """The rows of docs that may share a seed or hold a short item: all that do, and a few more where hashes meet in the bitmap."""
    bits, lengths = np.zeros(FILTER_BITS, bool), {0}
    for b in range(blocks):
        for n, own in index_of(items.where(F.col("block") == b), least).hashes().items():
            bits[own % np.uint64(FILTER_BITS)] = True
            lengths |= {n} if len(own) else set()
    sent = docs.sparkSession.sparkContext.broadcast((np.packbits(bits), sorted(lengths)))

    @F.pandas_udf("boolean")
    def shares(texts: pd.Series) -> pd.Series:
        packed, lengths = sent.value
        hashes, out = Hashed(), []
        for t in texts:
            h, hit = token_hashes(t, hashes), False
            for n in lengths:
                if len(h) >= (n or least):
                    at = shingles(h, n or least) % np.uint64(FILTER_BITS)
                    hit = hit or bool((packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).any())
            out.append(hit)
        return pd.Series(out)

    return docs.where(shares.asNondeterministic()(F.col("text")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each row of docs (doc_id, text) and benchmark item in it: doc_id, item_id, coverage, tiles, words (spans of word
    positions, ends exclusive).

    Words are runs of letters and digits, lower-cased. Null and empty texts have no entries, texts may be of any length; null items
    and items without a word are never found, an item of fewer than `least` words where all of them stand in a row (its first place is
    reported). Repeated items and repeated documents are reported each. Of equally long matches the one that starts first in the item,
    then in the document is a tile. Empty tables give no rows; further columns are not read.
    """
    return _found(docs.select("doc_id", "text"), benchmark, least, coverage, block_words).select("doc_id", F.inline("__leaks"))


def _found(docs: DataFrame, benchmark: DataFrame, least: int, coverage: float, block_words: int) -> DataFrame:
    """docs with __leaks; for a benchmark of several blocks a row for each block in which a document has leaks."""
    spark, items = docs.sparkSession, usable(benchmark)
    blocks = n_blocks(items, block_words)
    if blocks == 1:
        return docs.withColumn("__leaks", leaks(spark, index_of(items, least), least, coverage))
    items = staged(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")), "benchmark")
    some, out = staged(sharing(docs, items, blocks, least), "sharing"), None
    for b in range(blocks):
        met = some.withColumn("__leaks", leaks(spark, index_of(items.where(F.col("block") == b), least), least, coverage))
        met = staged(met.where(F.size("__leaks") > 0), "leaks")
        out = met if out is None else out.unionByName(met)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs, with their own columns, that hold no benchmark item.

    Null and empty texts hold none; texts are read whole. Of repeated rows all go or all stay. An empty table gives no rows, an empty
    benchmark takes none away. Rows travel as one struct, so further columns may have any names.
    """
    held = docs.select(F.struct("*").alias("doc"))
    if n_blocks(usable(benchmark), block_words) == 1:
        found = _found(held.select("doc", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text")), benchmark, least, coverage, block_words)
        return found.where(F.size("__leaks") == 0).select("doc.*")
    keys = lambda row: [F.coalesce(F.col(f"{row}doc_id").cast("string"), F.lit("null")), F.xxhash64(F.col(f"{row}text"))]
    id_, own = keys("")
    gone = _found(docs.select("doc_id", "text"), benchmark, least, coverage, block_words).select(id_.alias("gone_id"), own.alias("gone_text")).distinct()
    id_, own = keys("doc.")
    return held.join(gone, (id_ == F.col("gone_id")) & (own == F.col("gone_text")), "left_anti").select("doc.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "coverage", "tiles", F.to_json("words").alias("words"))
