"""Operator 11 against the tokenizers library, its automaton against a dictionary."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import SparkFiles
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from traffic_signals.llm import byte_pairs
from traffic_signals.llm.transducer import Transducer, compiled


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(byte_pairs.VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def lexicon(spark):
    return byte_pairs.lexicon_file(spark, [" the", " and", "ing", " walking", " talking", "é", " 12", "\n\n", ""])


@pytest.fixture(scope="module")
def codec(lexicon):
    return byte_pairs.Codec(SparkFiles.get(lexicon))


def ids_of(block: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(block) // 4}I", block))


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_query_matches_the_library(spark, data, library):
    texts = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = byte_pairs.op11_byte_pairs(spark, data).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted((r["doc_id"], *digests(library, r["text"])) for r in texts)


ALPHABET = ["a", "b", " ", "\n", "\t", "<|endoftext|>", "<|endof", "é", "՘", "日", "'s", "'LL", "1", "!", "‍", "\U000323b5", " the", "\x85", "\xa0", "　", "\x1c", "\0", "🙂"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30))
def test_texts_of_odd_pieces(library, codec, parts):
    text = "".join(parts)
    encoded = codec.encode([text])[0]
    assert ids_of(encoded) == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(encoded) == library.decode(ids_of(encoded), skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, codec, text):
    assert ids_of(codec.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point_splits_as_in_the_library(library, codec):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{c}1{c}! {c}" for c in points[at : at + 20_000])
        assert ids_of(codec.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_words_merged_together_and_alone(library, codec):
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcdehinorst\xc3\xa9", k=rng.randint(1, 60))) for _ in range(3000)] + [b"a" * n for n in range(1, 90)]
    assert codec.merges.merged_many(words) == [struct.pack(f"<{len(ids)}I", *ids) for ids in map(codec.merges.merged, words)]
    for text in ("x" * 60_000, "ab" * 30_000, "=" * 50_000, "é" * 30_000):
        assert ids_of(codec.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_decoding_any_ids(library, codec):
    rng = np.random.default_rng(3)
    for _ in range(500):
        ids = rng.integers(0, 50_257, 12).tolist()
        assert codec.decode(struct.pack("<12I", *ids)) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode(struct.pack("<2I", 4_000_000, 64)) == codec.decode(struct.pack("<I", 64))


def test_memory_of_pieces_is_bounded(library, codec, monkeypatch):
    monkeypatch.setattr(byte_pairs, "MEMO", 10)
    texts = [f"one two w{n} <|endoftext|> x{n}y" for n in range(50)]
    for text in texts:
        assert ids_of(codec.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
        assert len(codec.known) < 25


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 5), max_size=4).map(tuple), max_size=40))
def test_transducer_is_a_dictionary(words):
    t = Transducer(compiled(words.items()))
    asked = [*words, b"", b"a", b"zz", *(w + b"x" for w in words), *(w[:-1] for w in words)]
    assert [t.find(w) for w in asked] == [list(words[w]) if w in words else None for w in asked]
    assert t.holds(asked).tolist() == [w in words for w in asked]


def test_transducer_shares_ends():
    ends = [b"king", b"king's", b"kings"]
    words = {front + end: (n,) + ((9,) if end != b"king" else ()) for n, front in enumerate([b"wal", b"tal", b"chal", b"stal"]) for end in ends}
    # What a state says after it differs by no front, so all fronts lead to the states of one end.
    assert Transducer(compiled(words.items())).n_states < 2 * len(b"chal") + len(b"king's") + 6
    assert Transducer(compiled([])).find(b"") is None


def test_messy_rows(spark, lexicon, library):
    rows = [(None, None), (1, ""), (2, " \n\n "), (3, "word"), (3, "word"), (4, "x" * 50_000), (5, "a b\n" * 20_000), (None, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("ids", "n_tokens", "word", "count")})
    got = byte_pairs.decode(byte_pairs.encode(docs, lexicon).withColumn("text", F.lit("clash")), lexicon).collect()
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert [r["text"] for r in byte_pairs.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), lexicon).collect()] == [""]
    assert byte_pairs.encode(docs.limit(0), lexicon).count() == 0 and byte_pairs.frequent_words(docs.limit(0)) == []
    assert byte_pairs.frequent_words(docs, most=2) == []  # three words are as frequent as each other
    assert byte_pairs.frequent_words(docs, most=3) == ["\n", " b", "a"] and set(byte_pairs.frequent_words(docs)) == {"\n", " b", "a", "word"}
    odd = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert ids_of(byte_pairs.encode(odd, lexicon).first()["ids"]) == library.encode("a�b", add_special_tokens=False).ids
