"""Operator 11: byte-level BPE encoding and decoding through a lexicon of frequent words.

The words (pieces that the vocabulary's pattern splits a text into) are counted over the whole corpus in Spark. The most frequent ones,
a bounded number, are merged once on the driver and compiled into a minimal acyclic transducer (`transducer.py`). The lexicon is one
file, dealt to the executors by Spark and memory-mapped by the tasks. A word that it lacks is merged exactly, by rank and then from the
left; so the lexicon decides the speed and never the result.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_dir, staged
from .transducer import Transducer, compiled

VOCABULARY = "byte_bpe_50k.json"
LEXICON_WORDS = 32_768  # bound of the words in the lexicon
LEXICON_CHARS = 40  # longer words are merged whenever they occur
LENGTHS = (0, 8, 12, 20, 40)  # bytes of words that are merged together; longer ones by themselves
ROWS = 1 << 13  # words in a matrix
NO_PAIR = 1 << 31
MEMO = 1 << 18  # words that a task remembers at most
BATCH_BYTES = 1 << 21  # of text that is encoded at a time, about

# Code points that newer Unicode versions call letters or numbers, and the version of the tokenizers library doesn't know.
NEWER = (
    "՘ ֋-֌ ࢏ ౜ ೜ ₏ ₝-₟ ꟎-꟏ ꟒ ꟔ ꟝ ꟢ ꟱ ꭬-꭭ \U000107bb-\U000107bf \U00010940-\U00010959 "
    "\U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb \U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 "
    "\U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 "
    "\U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).split(" ")
UNKNOWN = "͸"  # neither letter, number nor white space in any version


@cache
def patterns() -> tuple[regex.Pattern, re.Pattern, re.Pattern]:
    """What splits texts, what finds code points from the first of NEWER on, and what finds those of NEWER."""
    return regex.compile(public_tokenizers.PATTERN), re.compile(f"[{NEWER[0]}-\U0010ffff]"), re.compile(f"[{''.join(NEWER)}]")


def pieces(text: str) -> list[str]:
    """The pieces of a text, in order; together they are the text."""
    split, far, newer = patterns()
    if text.isascii() or not far.search(text) or not newer.search(text):
        return split.findall(text)
    return [text[m.start() : m.end()] for m in split.finditer(newer.sub(UNKNOWN, text))]


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as it is, the rest from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Merges:
    """The vocabulary: bytes of each id, ids of the single bytes, ranks of pairs, special words."""

    def __init__(self, token_bytes: list[bytes | None], pairs: np.ndarray, specials: dict[str, int]):
        self.token_bytes, self.pairs, self.specials = token_bytes, pairs, specials
        self.byte_ids = [0] * 256
        for i, b in enumerate(token_bytes):
            if b is not None and len(b) == 1:
                self.byte_ids[b[0]] = i
        self.ranks = {a << 32 | b: rank for rank, (a, b, _) in enumerate(pairs.tolist())}
        self.news = pairs[:, 2].tolist()
        keys = pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1]
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[self.by_key], np.iinfo(np.int64).max)

    @classmethod
    def load(cls, path: str) -> Merges:
        """From a vocabulary file of the tokenizers library, byte-level and without normalizer."""
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, letters = whole["model"], byte_letters()
        vocab, specials = model["vocab"], {x["content"]: x["id"] for x in whole["added_tokens"]}
        token_bytes: list[bytes | None] = [None] * (1 + max([*vocab.values(), *specials.values()]))
        for token, i in vocab.items():
            token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in specials.items():
            token_bytes[i] = token.encode()
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return cls(token_bytes, np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], "<u4").reshape(-1, 3), specials)

    def merged(self, word: bytes) -> list[int]:
        """Exact merging of one word, n log n: the pair of lowest rank first, of equal ones the leftmost.

        Pairs lie in a heap; one that has changed since it was put there is passed over.
        """
        ids = [self.byte_ids[b] for b in word]
        n, rank_of = len(ids), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i) for i in range(n - 1) if (rank := rank_of(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = self.news[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (more := rank_of(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (more, i))
            h = before[i]
            if h >= 0 and (more := rank_of(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (more, h))
        return [i for i in ids if i >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_PAIR where they don't merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, np.append(self.by_key, 0)[at], NO_PAIR)

    def merged_many(self, words: list[bytes]) -> list[bytes]:
        """What `merged` gives for each word, as little-endian unsigned 32-bit integers; one row of a matrix a word, words of like length together."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in zip(LENGTHS, LENGTHS[1:], strict=False):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(group), ROWS):
                self._rows(words, sizes, group[at : at + ROWS], high, out)
        for n in np.flatnonzero(sizes > LENGTHS[-1]).tolist():
            ids = self.merged(words[n])
            out[n] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _rows(self, words: list[bytes], sizes: np.ndarray, own: np.ndarray, width: int, out: list[bytes]) -> None:
        size, place = sizes[own], np.arange(width)
        ids = np.zeros((len(own), width + 1), np.int64)
        ids[:, :width][place < size[:, None]] = np.array(self.byte_ids)[np.frombuffer(b"".join(words[n] for n in own.tolist()), np.uint8)]
        ranks = self.ranks_of(ids[:, :-1], ids[:, 1:])
        ranks[place >= size[:, None] - 1] = NO_PAIR
        news = np.array(self.news, np.int64)
        while len(own):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(own)), at]
            done = least == NO_PAIR
            if done.any():
                flat, step = ids[done].astype("<u4").tobytes(), 4 * (width + 1)
                for k, (n, count) in enumerate(zip(own[done].tolist(), size[done].tolist(), strict=True)):
                    out[n] = flat[k * step : k * step + 4 * count]
                own, size, ids, ranks, at, least = (x[~done] for x in (own, size, ids, ranks, at, least))
            if not len(own):
                return
            row, size = np.arange(len(own)), size - 1
            ids[row, at] = news[least]
            moved = place + (place > at[:, None])
            ids[:, :-1] = np.take_along_axis(ids, moved, 1)
            ranks = np.take_along_axis(np.append(ranks, np.full((len(own), 1), NO_PAIR), 1), np.where(place < at[:, None], place, place + 1), 1)
            ranks[row, at] = np.where(at < size - 1, self.ranks_of(ids[row, at], ids[row, at + 1]), NO_PAIR)
            some = np.flatnonzero(at)
            ranks[some, at[some] - 1] = self.ranks_of(ids[some, at[some] - 1], ids[some, at[some]])

    def packed(self) -> bytes:
        words = b"".join(b or b"" for b in self.token_bytes)
        sizes = np.array([0 if b is None else 1 + len(b) for b in self.token_bytes], "<u4")
        special = json.dumps(self.specials).encode()
        return struct.pack("<4I", len(sizes), len(words), len(self.pairs), len(special)) + sizes.tobytes() + words + self.pairs.tobytes() + special

    @classmethod
    def unpacked(cls, block: bytes) -> Merges:
        n, n_words, n_pairs, n_special = struct.unpack_from("<4I", block)
        at = 16 + 4 * n
        words, out, place = bytes(block[at : at + n_words]), [], 0
        for size in np.frombuffer(block, "<u4", n, 16).tolist():
            out.append(words[place : place + size - 1] if size else None)
            place += max(0, size - 1)
        at += n_words
        pairs = np.frombuffer(bytes(block[at : at + 12 * n_pairs]), "<u4").reshape(-1, 3)
        at += 12 * n_pairs
        return cls(out, pairs, json.loads(bytes(block[at : at + n_special])))


class Codec:
    """A memory-mapped lexicon; `known` remembers, for each piece, its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.block = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        (size,) = struct.unpack_from("<Q", self.block)
        self.merges = Merges.unpacked(self.block[8 : 8 + size])
        self.lexicon = Transducer(self.block, 8 + size)
        specials = sorted(self.merges.specials, key=lambda x: (-len(x), x))
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.known: dict[str, bytes] = {x: struct.pack("<I", i) for x, i in self.merges.specials.items()}
        self.spelled = [b or b"" for b in self.merges.token_bytes]

    def learn(self, new: list[str]) -> None:
        """Ids of pieces: the lexicon's, or, for those that it lacks, merged exactly."""
        words = [x.encode() for x in new]
        there = self.lexicon.holds(words)
        rest = np.flatnonzero(~there).tolist()
        self.known.update(zip((new[n] for n in rest), self.merges.merged_many([words[n] for n in rest]), strict=True))
        for n in np.flatnonzero(there).tolist():
            ids = self.lexicon.find(words[n])
            self.known[new[n]] = struct.pack(f"<{len(ids)}I", *ids)

    def split(self, text: str) -> list[str]:
        """Special tokens and the pieces between them."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += pieces(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + pieces(text[at:]) if at else pieces(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Pieces that are new are learned together."""
        each = [self.split(x) for x in texts]
        new = set().union(*each).difference(self.known)
        if new:
            if len(self.known) + len(new) > MEMO:
                specials = self.merges.specials
                self.known = {x: struct.pack("<I", i) for x, i in specials.items()}
                new = set().union(*each).difference(specials)
            self.learn(list(new))
        return [b"".join(map(self.known.__getitem__, own)) for own in each]

    def decode(self, ids: bytes) -> str:
        own = np.frombuffer(ids, "<u4")
        own = own[own < len(self.spelled)]
        return b"".join(map(self.spelled.__getitem__, own.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(name: str) -> Codec:
    """The lexicon file that Spark has dealt to this executor; mapped once in each Python worker."""
    return Codec(SparkFiles.get(name))


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts, at most `most`, in code point order.

    Words are counted partially before the shuffle. Counts fall into classes of about 2 %, of which the highest come in as long as they
    hold at most `most` words together; so only the classes' sizes and the chosen words reach the driver, however large the corpus.
    """
    each = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(public_tokenizers.PATTERN), F.lit(0))).alias("word")).where(F.length("word") <= LEXICON_CHARS)
    counted = each.groupBy("word").count().select("word", F.floor(F.log2("count") * 32).alias("class"))
    counted = staged(counted.where(F.col("class") > 0), "words")  # a word that occurs once is no frequent one
    sizes = sorted(counted.groupBy("class").count().collect(), reverse=True)  # 2,048 classes at most
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["class"]
    return [] if least is None else sorted(r["word"] for r in counted.where(F.col("class") >= least).collect())


def lexicon_file(spark: SparkSession, words: list[str], path: str | None = None) -> str:
    """Write vocabulary and lexicon to one file in the shared folder and have Spark deal it to the executors; returns its name.

    path: the vocabulary. A word that pieces() would split, or one that can't be written in UTF-8, does no harm: no piece asks for it.
    """
    merges = Merges.load(path or public_tokenizers.path(VOCABULARY))
    own = {w.encode("utf-8", "replace") for w in words if w}
    head = merges.packed()
    head += b"\0" * (-len(head) % 8)
    block = struct.pack("<Q", len(head)) + head + compiled((w, tuple(merges.merged(w))) for w in own)
    name = f"lexicon-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_dir(spark), name))
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    try:
        for i in range(0, len(block), 1 << 20):
            out.write(bytearray(block[i : i + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(at.toString())
    return name


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Both columns of so many rows at a time that the second has about BATCH_BYTES."""
    for batch in batches:
        keys, values = batch.column(0), batch.column(1)
        start, size = 0, 0
        for n in range(len(values)):
            size += len(values[n].as_buffer() or b"") if values[n].is_valid else 0
            if size >= BATCH_BYTES or n + 1 == len(values):
                yield keys.slice(start, n + 1 - start).to_pylist(), values.slice(start, n + 1 - start).to_pylist()
                start, size = n + 1, 0


def encode(docs: DataFrame, lexicon: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), one row for each row of docs (doc_id, text).

    A null or empty text has no ids. Strings of special tokens in a text become their ids, as the tokenizers library does unless told
    otherwise. Bytes that aren't UTF-8 count as replacement characters. Texts are read whole; a piece without a break of any length
    costs n log n. Repeated rows, and null doc_ids, are encoded each; an empty table gives no rows; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(lexicon)
        for ids, texts in _parts(batches):
            encoded = own.encode([(t or b"").decode("utf-8", "replace") for t in texts])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(encoded, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, lexicon: str) -> DataFrame:
    """doc_id, ids, text for each row of encoded (doc_id, ids). Ids that the vocabulary lacks are left out, null ids give an empty text,
    and bytes that aren't UTF-8 become replacement characters. An empty table gives no rows; further columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(lexicon)
        for ids, encoded in _parts(batches):
            texts = [own.decode(x or b"") for x in encoded]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x or b"" for x in encoded], pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lexicon = lexicon_file(spark, frequent_words(docs))
    both = decode(encode(docs, lexicon), lexicon)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
