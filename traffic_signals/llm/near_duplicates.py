"""Operator 9: near-duplicates by MinHash: many universal hash minima, banding, signature verification, components by stars.

1. One scan turns every whole text into its set of word shingles, and that into a 128-bit digest of the set, minima under universal
   hash functions, the keys of the bands, and a signature of one byte for each minimum. Rows with equal sets form a class, whatever
   their ids; everything below works on classes.
2. Classes that share a band key are candidates. Inside a bucket (dealt over blocks of bounded size) signatures are compared, and only
   a forest of links is proposed, never all pairs.
3. Proposed links are confirmed on the full sets, and the confirmed ones give components by alternating large-star and small-star.
4. Buckets that still hold several components are searched again, in pairs of blocks that hold the full sets as well: every two classes
   of different components whose set sizes and signatures allow the similarity are compared on their sets there and then, in the first
   bucket that they share, so no link between parts is lost and nothing but links comes out.

What is probabilistic: a link at the threshold is missed by all bands with probability (1 - 0.8^5)^32 = 3e-6, and by the signature
test (4.5 standard deviations below the threshold) with about 3e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Hashes, mixed, read, shingles, staged, word_hashes, words
from .components import components

BANDS, ROWS = 32, 5
PERCENT = 80
BLOCK = 512  # classes of a bucket that are compared in one task
ROWS_PER_BIN = 20_000
SET_BYTES = 32 << 20  # bytes of shingle sets that one bin of links or one pair of blocks holds, about
BROADCAST_IDS = 200_000  # ids up to which a set of ids is broadcast
DEVIATIONS = 4.5


class MinHash:
    """Minima under multiply-shift hash functions (a x + b mod 2^64, upper half), a universal family."""

    def __init__(self, n: int = BANDS * ROWS, seed: int = 9):
        r = np.random.default_rng(seed)
        self.a = r.integers(0, 1 << 63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = r.integers(0, 1 << 63, (n, 1), dtype=np.uint64) * np.uint64(2)

    def minima(self, sets: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in range(0, len(sets), 1024):
            low = np.minimum(low, (self.a * sets[None, at : at + 1024] + self.b).min(1))
        return low >> np.uint64(32)


def shingle_set(text: str | None, hashes: Hashes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a whole text."""
    return np.unique(shingles(word_hashes(words(text), hashes), k))


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def text_key(text: Column) -> Column:
    """Tells the texts of rows that share a doc_id apart."""
    return F.xxhash64(text)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, own, n_shingles, digest, bands, signature); a document without words has no digest and takes part in nothing."""

    @F.pandas_udf("n_shingles long, digest binary, bands array<long>, signature binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        hashes, family, out = Hashes(), MinHash(), []
        for text in texts:
            s = shingle_set(text, hashes, k)
            if not len(s):
                out.append((0, None, None, None))
                continue
            low = family.minima(s)
            key = np.zeros(BANDS, np.uint64)
            for j in range(ROWS):
                key = mixed(key * np.uint64(0xD1342543DE82EF95) + low.reshape(BANDS, ROWS)[:, j])
            key = mixed(key + np.arange(BANDS, dtype=np.uint64))
            out.append((len(s), digest(s), key.view(np.int64), (low & np.uint64(255)).astype(np.uint8).tobytes()))
        return pd.DataFrame(out, columns=["n_shingles", "digest", "bands", "signature"])

    made = docs.select("doc_id", text_key(F.col("text")).alias("own"), sketch.asNondeterministic()("text").alias("s"))
    return made.select("doc_id", "own", "s.*")


def agreement(j: float, deviations: float) -> float:
    """The share of equal signature bytes at similarity j, so many standard deviations above, plus chance equality."""
    low = j + deviations * (j * (1 - j) / (BANDS * ROWS)) ** 0.5
    return low + (1 - low) / 256


class Parts:
    """Union-find over the rows of a block, of which those of a component are one part from the start."""

    def __init__(self, roots: np.ndarray):
        self.of = np.unique(roots, return_inverse=True)[1].tolist()
        self.up = list(range(len(self.of)))

    def find(self, i: int) -> int:
        p = self.of[i]
        while self.up[p] != p:
            self.up[p] = self.up[self.up[p]]
            p = self.up[p]
        return p

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def least_agreement(percent: int) -> int:
    """Equal signature bytes that a link shows at least."""
    return math.ceil(agreement(percent / 100, -DEVIATIONS) * BANDS * ROWS - 1e-9)


def forest(nodes: np.ndarray, sig: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the classes of one block (nodes rising) as all links that signatures allow would: of those that are as good as
    certain the ones between the least nodes, so that the buckets of a group propose the same."""
    none = np.empty(0, np.int64)
    us, vs, eq = [none], [none], [none]
    least, sure = least_agreement(percent), math.ceil(agreement(percent / 100, 3) * BANDS * ROWS)
    for i in range(len(nodes) - 1):
        same = (sig[i + 1 :] == sig[i]).sum(1)
        keep = np.flatnonzero(same >= least)
        us.append(np.full(len(keep), i))
        vs.append(keep + i + 1)
        eq.append(same[keep])
    us, vs, eq = np.concatenate(us), np.concatenate(vs), np.concatenate(eq)
    parts = Parts(nodes)
    return [(int(nodes[us[k]]), int(nodes[vs[k]])) for k in np.lexsort((vs, us, -np.minimum(eq, sure))).tolist() if parts.join(us[k], vs[k])]


def blocks_of(pdf: pd.DataFrame, keys: list[str]) -> Iterator[pd.DataFrame]:
    """The blocks in a bin, nodes rising."""
    pdf = pdf.sort_values([*keys, "node"], ignore_index=True)
    fresh = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
    starts = np.append(np.flatnonzero(fresh), len(pdf))
    return (pdf.iloc[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True) if b - a > 1)


def matrix(column: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def forests(pdf: pd.DataFrame, keys: list[str], percent: int) -> pd.DataFrame:
    pairs = {pair for block in blocks_of(pdf, keys) for pair in forest(block["node"].to_numpy(), matrix(block["signature"], np.uint8), percent)}
    return pd.DataFrame(sorted(pairs), columns=["u", "v"])


def links_within(block: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Confirmed links that join the components of one block, or of the two sides of a pair of blocks, as all links would.

    Two classes are compared only if this is the first bucket that they share: in the others they are compared there.
    """
    nodes, roots, side = block["node"].to_numpy(), block["root"].to_numpy(), block["side"].to_numpy()
    sig, bands, at = matrix(block["signature"], np.uint8), np.stack(block["bands"].to_list()), int(block["at"].iat[0])
    sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
    parts, two, least, out = Parts(roots), side.min() != side.max(), least_agreement(percent), []
    for i in range(len(nodes) - 1):
        can = (roots[i + 1 :] != roots[i]) & (nodes[i + 1 :] != nodes[i])
        if two:
            can &= side[i + 1 :] != side[i]
        j = np.flatnonzero(can) + i + 1
        j = j[(sig[j] == sig[i]).sum(1) >= least]
        j = j[(bands[j] == bands[i]).argmax(1) == at]
        for k in j.tolist():
            if parts.find(i) != parts.find(k) and similar(sets[i], sets[k], percent):
                parts.join(i, k)
                out.append((int(nodes[i]), int(nodes[k])))
    return out


def proposed(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Forests of the buckets (band, node, n), a large bucket dealt over blocks.

    There are two ways of dealing, and the number of blocks is a power of two: the buckets of a large group mostly have the same blocks,
    so they propose the same links instead of others in each band, while the blocks of one way are joined by those of the other.
    """
    rows = buckets.join(classes.select("node", "signature"), "node")
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.ceil(F.col("n") / BLOCK).cast("double")))).cast("long")
    block = F.pmod(F.xxhash64("node", F.pmod("band", F.lit(2))), blocks)
    bins = max(1, -(-buckets.count() // ROWS_PER_BIN))
    rows = rows.select(F.pmod(F.xxhash64("band", block), F.lit(bins)).alias("bin"), "band", block.alias("block"), "node", "signature")
    return rows.groupBy("bin").applyInPandas(lambda pdf: forests(pdf, ["band", "block"], percent), "u long, v long").distinct()


def remaining(buckets: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The links (u, v) between different components that share a bucket, found in pairs of blocks.

    A block holds classes of like set size, and so many that their sets fit; a large component has blocks of its own, small ones share
    blocks. Pairs of blocks within one component, and of sizes that are too far apart for the similarity, fall away.
    """
    rooted = buckets.join(roots, "node", "left").select("band", "at", "node", F.coalesce("root", "node").alias("root"))
    several = rooted.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    # Sizes of a link differ by less than a step and a bit, so their steps by one at most.
    base = 100 / percent * 1.01
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(base)).cast("int")
    rows = staged(rooted.join(several, "band").join(classes.select("node", step.alias("step")), "node"), "mixed-buckets")
    cap = F.greatest(F.lit(2.0), F.least(F.lit(float(BLOCK)), SET_BYTES / (8 * F.pow(F.lit(base), F.col("step") + 1))))
    parts = rows.groupBy("band", "step", "root").agg(F.count("*").alias("own"))
    large = F.col("own") > cap / 2
    shared = parts.where(~large).groupBy("band", "step").agg(F.sum("own").alias("small"))
    sized = parts.join(shared, ["band", "step"], "left")
    sized = sized.select("band", "step", "root", F.ceil(F.when(large, F.col("own")).otherwise(F.col("small")) / cap).alias("pieces"), F.when(large, F.col("root")).otherwise(-1).alias("only"))
    piece = F.pmod(F.when(F.col("only") >= 0, F.xxhash64("node")).otherwise(F.xxhash64("root")), F.col("pieces"))
    held = rows.join(sized, ["band", "step", "root"]).select("band", "at", F.struct("step", "only", piece.alias("piece")).alias("own"), "node", "root")
    held = staged(held, "mixed-blocks")
    left = held.groupBy("band", F.col("own").alias("p")).agg(F.count("*").alias("p_rows"))
    right = left.select("band", F.col("p").alias("q"), F.col("p_rows").alias("q_rows"))
    tasks = left.join(right, "band").where("p <= q and q.step - p.step <= 1 and (p.only < 0 or p.only <> q.only) and (p <> q or p_rows > 1)")
    one = F.struct(F.col("p").alias("own"), F.lit(0).alias("side"), F.col("p_rows").alias("rows"))
    two = F.struct(F.col("q").alias("own"), F.when(F.col("p") == F.col("q"), 0).otherwise(1).alias("side"), F.col("q_rows").alias("rows"))
    tasks = staged(tasks.select("band", F.xxhash64("p", "q").alias("task"), F.inline(F.array_distinct(F.array(one, two)))), "block-pairs")
    wanted = staged(held.select("node").distinct().join(classes.select("node", "digest", "least.*", "n_shingles"), "node"), "wanted")
    n, size = wanted.agg(F.count("*"), F.sum("n_shingles")).first()
    total = tasks.agg(F.sum("rows")).first()[0] or 0
    bins = max(1, math.ceil(total * (500 + 8 * (size or 0) / max(1, n)) / SET_BYTES))
    dealt = tasks.join(held, ["band", "own"]).select(F.pmod(F.xxhash64("band", "task"), F.lit(bins)).alias("bin"), "band", "at", "task", "node", "root", "side")
    dealt = dealt.join(classes.select("node", "signature", "bands").join(sets_of(wanted, n, docs, k), "node"), "node")

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        links = {link for block in blocks_of(pdf, ["band", "task"]) for link in links_within(block, percent)}
        return pd.DataFrame(sorted(links), columns=["u", "v"])

    return staged(dealt.groupBy("bin").applyInPandas(linked, "u long, v long"), "links")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def sets_of(wanted: DataFrame, n: int, docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of n wanted classes (node, digest, doc_id, own), from the whole texts."""

    @F.pandas_udf("digest binary, shingles binary")
    def full(texts: pd.Series) -> pd.DataFrame:
        hashes = Hashes()
        sets = [shingle_set(t, hashes, k) for t in texts]
        return pd.DataFrame({"digest": [digest(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    asked = wanted.select("node", "digest", "doc_id", "own")
    texts = docs.select("doc_id", text_key(F.col("text")).alias("own"), "text").join(F.broadcast(asked) if n <= BROADCAST_IDS else asked, ["doc_id", "own"])
    # A text may have several rows.
    return texts.select("node", "digest", full.asNondeterministic()("text").alias("s")).where("digest = s.digest").groupBy("node").agg(F.first("s.shingles").alias("shingles"))


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets have 100 * intersection >= percent * union.

    Pairs are dealt over bins by a hash, as many as the sets' bytes ask for, so no class makes a bin large; a set travels once to a bin.
    """
    ends = F.explode(F.array("u", "v")).alias("node")
    wanted = staged(pairs.select(ends).distinct().join(classes.select("node", "digest", "least.*", "n_shingles"), "node"), "wanted")
    n, size = wanted.agg(F.count("*"), F.sum("n_shingles")).first()
    bins = max(1, math.ceil(2 * pairs.count() * 8 * (size or 0) / max(1, n) / SET_BYTES))

    def linked(pdf: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sets = {i: np.frombuffer(raw, np.uint64) for i, raw in zip(held["node"], held["shingles"], strict=True)}
        fits = [u in sets and v in sets and similar(sets[u], sets[v], percent) for u, v in zip(pdf["u"], pdf["v"], strict=True)]
        return pdf.loc[np.array(fits, bool), ["u", "v"]]

    dealt = pairs.select(F.pmod(F.xxhash64("u", "v"), F.lit(bins)).alias("bin"), "u", "v")
    held = dealt.select(F.col("bin").alias("for_bin"), ends).distinct().join(sets_of(wanted, n, docs, k), "node")
    return staged(dealt.groupBy("bin").cogroup(held.groupBy("for_bin")).applyInPandas(linked, "u long, v long"), "links")


def rows_with_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, own, n_shingles, part, component_id): one row for each row of docs; part names the component, null without words or id."""
    sk = staged(sketches(docs, k), "sketches")
    named = sk.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = named.groupBy("digest").agg(F.min(F.struct("doc_id", "own")).alias("least"), F.first(F.struct("n_shingles", "bands", "signature")).alias("s"))
    # Numbers are fixed once the table is written; doc_ids would not do, as one may have several texts.
    classes = staged(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "least", "s.*"), "classes")
    keyed = classes.select("node", F.posexplode("bands").alias("at", "band"))
    full = keyed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    buckets = staged(keyed.join(full, "band"), "buckets")
    links = confirmed(staged(proposed(buckets, classes, percent), "candidates"), classes, docs, k, percent)
    roots = staged(components(links), "roots")
    more = remaining(buckets, classes, roots, docs, k, percent)
    if not more.isEmpty():
        roots = staged(components(more.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))), "roots")
    # Only now the least doc_id of each component.
    placed = classes.select("node", "digest", F.col("least.doc_id").alias("id")).join(roots, "node", "left")
    least = placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("component_id"))
    found = placed.join(least, "root", "left").select("digest", F.coalesce("root", "node").alias("part"), F.coalesce("component_id", "id").alias("component_id"))
    out = sk.select("doc_id", "own", "n_shingles", "digest").join(staged(found, "class-components"), "digest", "left")
    has_id = F.col("doc_id").isNotNull()
    return out.select("doc_id", "own", "n_shingles", F.when(has_id, F.col("part")).alias("part"), F.when(has_id, F.coalesce("component_id", "doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs (doc_id, text).

    A-Z are lower-cased, words are runs without ASCII white space. Null, empty and blank texts have an empty set and are linked with
    nothing; fewer than k words are one shingle. component_id is the least doc_id that links reach; kept tells whether it is the
    row's own. Rows with equal sets, repeated ones too, are always one component. A null doc_id has a null component, takes no part
    and is kept. Where rows with one doc_id have different texts, each row belongs where its own text does. Texts may be of any
    length; ties of similarity at the threshold are links. An empty table gives no rows; further columns of docs are not read.
    """
    out = rows_with_components(docs, k, percent).drop("own", "part")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def drop_near_duplicates(docs: DataFrame, k: int = 4, percent: int = PERCENT) -> DataFrame:
    """docs with its own columns and one row of each component: of the rows with its least doc_id the one with the least hash of its
    text, so that reruns agree. Rows without a doc_id, and texts without words under an id of their own, all stay. An empty table gives
    no rows; further columns stay, whatever their names."""
    found = staged(rows_with_components(docs, k, percent).where(F.col("part").isNotNull()).select(F.col("doc_id").alias("d_id"), F.col("own").alias("d_own"), "part"), "near-duplicates")
    groups = found.groupBy("part").agg(F.count("*").alias("n"), F.min(F.struct("d_id", "d_own")).alias("best")).where("n > 1")
    rows = staged(found.join(groups, "part").groupBy("d_id", "d_own", "best").count(), "grouped")
    gone = rows.where("d_id <> best.d_id or d_own <> best.d_own").select("d_id", "d_own")
    twice = rows.where("d_id = best.d_id and d_own = best.d_own and count > 1").select("d_id", "d_own")
    send = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    # Rows travel as one struct, so that no column of theirs can clash with what is joined.
    here = (F.col("doc.doc_id") == F.col("d_id")) & (text_key(F.col("doc.text")) == F.col("d_own"))
    kept = docs.select(F.struct("*").alias("doc")).join(send(gone), here, "left_anti")
    if twice.isEmpty():
        return kept.select("doc.*")
    twice = send(twice)
    return kept.join(twice, here, "left_anti").select("doc.*").unionByName(kept.join(twice, here, "left_semi").select("doc.*").dropDuplicates(["doc_id", "text"]))


SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), each AS (
  SELECT doc_id, unnest(w) AS w0, generate_subscripts(w, 1) AS i, len(w) AS n FROM t
), shingled AS (
  SELECT doc_id, n, w0 || ' ' || lead(w0, 1) OVER o || ' ' || lead(w0, 2) OVER o || ' ' || lead(w0, 3) OVER o AS s FROM each WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM shingled WHERE s IS NOT NULL UNION SELECT doc_id, array_to_string(w, ' ') FROM t WHERE len(w) BETWEEN 1 AND 3
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * common >= 80 * (x.n + y.n - common)
), edges AS MATERIALIZED (
  SELECT u, v FROM links UNION SELECT v, u FROM links
), reach(node, least) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT v, least FROM reach JOIN edges ON u = node
)
SELECT node AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(least) AS component_id, node = min(least) AS kept FROM reach LEFT JOIN sizes ON doc_id = node GROUP BY node, n
"""
