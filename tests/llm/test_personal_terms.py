"""Words that give people away, planted into the documents of the tables: how many are found, and how much else is."""

import random

from pyspark.sql import functions as F

from traffic_signals.llm import personal_data

PLAIN = "meeting report budget project office manager review holiday invoice weekly planning customer delivery contract team".split()


def planted(people=12, texts=5):
    """Texts of people, each with the person's address, an own code word, and words that all share; (doc_id, text, code word's places)."""
    rng, rows = random.Random(8), []
    for p in range(people):
        code, name = ("".join(rng.choices("bcdfghjklm", k=8)) for _ in range(2))
        for t in range(texts):
            words = rng.choices(PLAIN, k=30)
            at = sorted(rng.sample(range(30), 2))
            for i in at:
                words[i] = code
            rows.append((900_000 + 10 * p + t, " ".join(words) + f" {name}@firm{p}.example", code))
    return rows


def test_planted_code_words(spark, data):
    rows = planted()
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    every = docs.unionByName(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    got = {r["doc_id"]: r["spans"] for r in personal_data.report(every).where("doc_id >= 900000").collect()}
    wanted = found = right = 0
    for i, text, code in rows:
        places = {(k, k + len(code)) for k in range(len(text)) if text.startswith(code, k)}
        spans = {tuple(map(int, s.split(":")[1:])) for s in got[i].split(",") if s.startswith("term")}
        wanted, found, right = wanted + len(places), found + len(spans), right + len(places & spans)
    assert wanted == 120 and right / wanted >= 0.95 and right / found >= 0.95
    clean = {r["doc_id"]: r["text"] for r in personal_data.sanitise(every).where("doc_id >= 900000").collect()}
    assert not any(code in clean[i] or "@" in clean[i] for i, _, code in rows) and all(any(w in clean[i] for w in PLAIN) for i, _, _ in rows)


def test_words_that_all_share_stay(spark, data):
    rows = [(i, text.replace(code, "colleague")) for i, text, code in planted()]
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = personal_data.report(docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))).where("doc_id >= 900000")
    assert got.where(F.col("spans").contains("term")).count() == 0
