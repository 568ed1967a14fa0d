"""Operator 12: runs of repeated words, and texts with each run collapsed to its first period.

A run is a stretch of words that repeats with a smallest period and that no neighbouring word extends. Each run holds a Lyndon root, the
longest Lyndon word that begins at one of its words, under the order of words or under its reverse. Both Lyndon arrays come directly from
the first phase of Baier's suffix sorter (suffixes are put into groups, which are refined from the highest down); no suffix array is
made. Each root is then extended to both sides by longest common extensions, which compare names of stretches of 1, 2, 4, ... words.

Only stretches of words that can lie in a wanted run are looked at. In a run of at least L words and e periods each window of L - L/e
words occurs a second time, so words that no repeated window covers lie in no such run. This spares ordinary prose and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, mixed, read, word_hashes

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
CHUNK = 1 << 17  # words that are worked on together, about; a longer text by itself
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place; symbols are 0, 1, ... without gaps. The end is less than any symbol.

    Baier's phase one: suffixes start grouped by symbol. The groups are taken from the highest down. Each member looks for the nearest
    suffix in front of it that is in a lower group (those in higher groups are unlinked by then); that one's Lyndon word takes in the
    member's. Suffixes that gain the same number of words move, together, to a group of their own right above their old one.
    """
    n = len(symbols)
    members: list[list[int]] = [[] for _ in range(max(symbols, default=-1) + 1)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    group, length = list(symbols), [1] * n
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    at = len(members) - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]
        members[at] = []
        own.sort()
        gained: dict[int, int] = {}
        for i in own:
            lo, hi = left[i], right[i]
            if hi < n:
                left[hi] = lo
            if lo >= 0:
                right[lo] = hi
                gained[lo] = gained.get(lo, 0) + 1
        if gained:
            size = length[own[0]]
            by: dict[tuple[int, int], list[int]] = {}
            for i, times in gained.items():
                by.setdefault((-times, group[i]), []).append(i)
            for (times, old), moved in sorted(by.items()) if len(by) > 1 else by.items():
                new, top = len(members), above[old]
                members.append(moved)
                below.append(old)
                above.append(top)
                above[old] = new
                if top >= 0:
                    below[top] = new
                for i in moved:
                    group[i] = new
                    length[i] -= times * size
        at = below[at]
    return length


class Extensions:
    """Longest common extensions of a sequence, exact: stretches of 2^k symbols have equal names where they are equal."""

    def __init__(self, symbols: np.ndarray):
        self.n, self.names = len(symbols), [symbols.astype(np.int64)]
        while len(own := self.names[-1]) > (half := 1 << (len(self.names) - 1)):
            pairs = own[:-half] * (int(own.max()) + 1) + own[half:]
            names, new = np.unique(pairs, return_inverse=True)
            if len(names) == len(pairs):  # no stretch of this length occurs twice
                break
            self.names.append(new)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and b, a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            fits = np.flatnonzero(b + out + (1 << k) <= self.n)
            same = self.names[k][a[fits] + out[fits]] == self.names[k][b[fits] + out[fits]]
            out[fits[same]] += 1 << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix of what stands before a and before b, a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            fits = np.flatnonzero(a - out >= 1 << k)
            same = self.names[k][a[fits] - out[fits] - (1 << k)] == self.names[k][b[fits] - out[fits] - (1 << k)]
            out[fits[same]] += 1 << k
        return out


def runs_of(symbols: np.ndarray, least: int = 0, times: int = 2) -> np.ndarray:
    """(start, length, period) rows of the runs of at least `least` symbols and `times` (2 or more) periods, by start, then period.

    symbols are whole numbers, 0, 1, ... without gaps.
    """
    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), np.int64)
    own, most = symbols.tolist(), int(symbols.max())
    start = np.tile(np.arange(n), 2)
    period = np.array(lyndon_lengths(own) + lyndon_lengths([most - s for s in own]), np.int64)
    fits = start + period < n
    start, period = start[fits], period[fits]
    near = Extensions(symbols)
    ahead = near.forward(start, start + period)
    behind = near.backward(start, start + period)
    length = behind + period + ahead
    wanted = length >= np.maximum(least, times * period)
    found = np.unique(np.stack([start - behind, length, period], 1)[wanted], axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _covered(hashes: np.ndarray, own: np.ndarray, window: int) -> np.ndarray:
    """Whether a window that occurs twice in its text covers each word; own: the number of each word's text."""
    n = len(hashes) - window + 1
    if n < 2:
        return np.zeros(len(hashes), bool)
    h, size = hashes.copy(), 1
    while size < window:  # windows of 2, 4, ... words, the last two of which may overlap
        step = min(size, window - size)
        h = mixed(h[:-step] * np.uint64(0xD1342543DE82EF95) + h[step:])
        size += step
    h = mixed(h + own[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    inside = own[:n] == own[window - 1 :]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    places = np.flatnonzero(again & inside)
    np.add.at(change, places, 1)
    np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0


def text_runs(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES, hashes: Hashes | None = None) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the wanted runs of each text, a list of words, by start, then period.

    Stretches of all texts are worked on as one sequence, with symbols between them that occur once.
    """
    hashes = Hashes() if hashes is None else hashes
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    own, first = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    inside = _covered(np.concatenate([word_hashes(t, hashes) for t in texts]), own, max(1, least - least // times))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.where(inside, own + 1, 0), [0]])))
    symbols: list[int] = []
    places: list[int] = []
    ids: dict[bytes | tuple, int] = {}
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        if inside[lo] and hi - lo >= least:
            doc = int(own[lo])
            part = texts[doc][lo - int(first[doc]) : hi - int(first[doc])]
            symbols += [ids.setdefault(w, len(ids)) for w in part]
            symbols.append(ids.setdefault((lo,), len(ids)))
            places += range(lo, hi + 1)
    if symbols:
        for start, length, period in runs_of(np.array(symbols), least, times).tolist():
            doc = int(own[places[start]])
            out[doc].append((places[start] - int(first[doc]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without what follows the first period of each run."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (array of start, length, period in words, by start, then period) and collapsed (the text's words, joined by one space,
    without what follows the first period of each run), one row for each row of docs (doc_id, text).

    A null or empty text has no words and no runs. Words are compared byte by byte. Texts are read whole; one of n words takes n log n
    steps and 16 log n bytes a word, only for the stretches that a repeated window covers. Repeated rows, and null doc_ids, are
    worked on each; an empty table gives no rows; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for ids, texts in _chunks(batch):
                found = text_runs(texts, least, times, hashes)
                runs = pa.array([[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found], RUN_TYPE)
                short = pa.array([collapsed(t, own) for t, own in zip(texts, found, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), runs, short], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, RUNS)
    return rows.withColumn("collapsed", F.col("collapsed").cast("string"))


RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of so many rows that they have about CHUNK words."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0), batch.column(1), strict=True):
        words = (t.as_py() or b"").split()  # ASCII white space alone, as the contract asks
        ids.append(i.as_py())
        texts.append(words)
        size += len(words)
        if size >= CHUNK:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def periodic_tails(doc_id: Column, text: Column) -> Column:
    """Texts of which every tenth, by the CRC of its id, repeats its words from some place on: word i >= a becomes word a + (i - a) % p,
    with g = crc32(id) / 10, a = g % n and p = 1 + (n - a) / (3 + g % 8), n being the number of words. All whole-number arithmetic."""
    crc = F.crc32(doc_id.cast("string"))
    g = F.floor(crc / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.when(n > 0, g % F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (3 + g % 8))

        def each(b: Column) -> Column:
            place = lambda i: F.when(i < b["a"], i).otherwise(b["a"] + (i - b["a"]) % b["p"])
            return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i).cast("int"))), " ")

        return F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), each)[0]

    # Words are bound once, as the argument of a function, so that no step splits the text again.
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    new = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return F.when(F.coalesce(crc % 10 == 0, F.lit(False)), F.coalesce(new, text)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", periodic_tails(F.col("doc_id"), F.col("text")).alias("text")))

    def first(a: Column, b: Column) -> Column:
        """Greatest length/period first, compared exactly; then the smallest start, then period."""
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(F.signum(a["period"] - b["period"]).cast("int"))

    best = F.get(F.array_sort("runs", first), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
