"""Operator 12 against brute force: Lyndon words by definition, runs by comparing words a period apart."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from traffic_signals.llm import periodic_runs


def dense(symbols):
    known = {x: i for i, x in enumerate(sorted(set(symbols)))}
    return [known[x] for x in symbols]


def brute_lyndon(s):
    """The longest Lyndon word at i ends where the next smaller suffix begins."""
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(s, least, times):
    found = []
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and not any(all(s[i + k] == s[i + k + d] for k in range(length - d)) for d in range(1, q)):
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_words(symbols):
    assert periodic_runs.lyndon_lengths(dense(symbols)) == brute_lyndon(symbols)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=6).flatmap(lambda p: st.integers(1, 6).map(lambda n: p * n)), max_size=6))
def test_runs(parts):
    symbols = dense([x for p in parts for x in p])
    for least, times in ((0, 2), (6, 3), (9, 2)):
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(symbols, int), least, times).tolist()] == brute_runs(symbols, least, times)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=1, max_size=11).flatmap(lambda p: st.integers(1, 30).map(lambda n: p * n)), max_size=4), max_size=4))
def test_runs_of_texts(texts):
    texts = [[w for part in t for w in part] for t in texts]
    assert periodic_runs.text_runs(texts) == [brute_runs(t, 24, 3) for t in texts]


def test_long_texts():
    rng = random.Random(5)
    prose = [b"w%d" % rng.randrange(500) for _ in range(30_000)]
    block = prose[:700]
    text = prose + block * 3 + block[:10] + [b"x"] + [b"a"] * 40_000 + [b"a", b"b"] * 20_000
    # The block's third copy goes on into its first words; what follows is no word of it.
    assert periodic_runs.text_runs([text]) == [[(30_000, 2110, 700), (32_111, 40_001, 1), (72_111, 40_000, 2)]]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 24, 3)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(lines), digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.substring("text", 1, 3000).alias("text"))
    planted = [(9_000 + i, "a b c " * i + "x " * (i % 30) + "a b c d " * (i // 2)) for i in range(60)] + [(9_500, None), (9_501, ""), (9_501, ""), (9_502, " \n\t"), (9_503, " \x0b\x1cz" * 40), (9_504, " z" * 40)]
    rows = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string")).withColumns({c: F.lit("clash") for c in ("runs", "collapsed", "best", "start")})
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == sorted((expected(r["doc_id"], r["text"]) for r in rows.collect()), key=str)
    assert sum(r[1] > 0 for r in got) > 60


def test_messy_rows(spark):
    rows = [(None, "a " * 30), (1, None), (2, " \n\n "), (3, "word"), (3, "word"), (4, "x" * 100_000), (5, "a b\n" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("runs", "collapsed", "start", "period")})
    got = sorted((tuple(map(str, (r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"])))) for r in periodic_runs.find_runs(docs).collect())
    assert got == sorted([("None", "[(0, 30, 1)]", "a"), ("1", "[]", ""), ("2", "[]", ""), ("3", "[]", "word"), ("3", "[]", "word"), ("4", "[]", "x" * 100_000), ("5", "[(0, 40000, 2)]", "a b")])
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    tails = docs.select("doc_id", periodic_runs.periodic_tails(F.col("doc_id"), F.col("text")).alias("text"))
    assert sorted(map(str, (r["doc_id"] for r in tails.collect()))) == sorted(str(i) for i, _ in rows)


def test_collapsing_overlapping_runs():
    words = [b"a"] * 30 + [b"b"] + ([b"a"] * 30 + [b"b"]) * 2
    runs = brute_runs(words, 24, 3)
    assert len(runs) == 4
    assert periodic_runs.collapsed(words, runs) == b"a b"


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny(n):
    assert periodic_runs.runs_of(np.zeros(n, int)).tolist() == ([[0, 2, 1]] if n == 2 else [])
