"""Stages of the pipeline, and the whole chain, on messy rows whose further columns have the names that operators use inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from traffic_signals.llm import decontaminate, line_quality, near_duplicates

NAMES = ["d_id", "d_own", "doc", "__id", "__own", "__leaks", "__quality", "gone_id", "gone_text", "part", "best", "count", "own", "label", "score", "kept", "key", "size", "item_id"]
PROSE = "the quick brown fox jumps over the lazy dog and runs away from all of them into the deep green wood "
ROWS = [
    (None, None), (None, PROSE * 3), (1, ""), (2, " \n\n "), (3, "word"), (3, "word"), (4, PROSE * 3), (5, PROSE * 3), (5, PROSE * 3), (6, PROSE * 3 + "at last"), (7, "x" * 50_000), (8, "a b\n" * 10_000),
    (9, "one passage of the benchmark that has many words stands in this text right here " + PROSE),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 2 == 0, "a"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in NAMES})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one passage of the benchmark that has many words stands in this text"), (2, None), (3, "zzz yyy xxx www vvv uuu")], "item_id long, text string")


def ids(df):
    return sorted(str(r["doc_id"]) for r in df.collect())


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_drop_leaks(docs, benchmark, block_words):
    kept = decontaminate.drop_leaks(docs, benchmark, block_words=block_words)
    assert kept.columns == docs.columns and ids(kept) == sorted(str(i) for i, _ in ROWS if i != 9)
    assert {r[c] for r in kept.select(*NAMES).distinct().collect() for c in NAMES} == {"clash"}
    assert ids(decontaminate.drop_leaks(docs, benchmark.limit(0))) == ids(docs) and decontaminate.drop_leaks(docs.limit(0), benchmark, block_words=block_words).count() == 0


def test_drop_near_duplicates(docs):
    kept = near_duplicates.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(["None", "None", "1", "2", "3", "4", "7", "8", "9"])
    assert near_duplicates.drop_near_duplicates(docs.limit(0)).count() == 0


def test_keep_good(spark, docs):
    labels = spark.createDataFrame([(i, int(i != 8)) for i in range(1, 10)], "doc_id long, quality int")
    kept = line_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and set(ids(kept)) <= set(ids(docs))
    assert ids(line_quality.keep_good(docs, labels.limit(0))) == ids(docs)


def test_the_whole_chain_on_messy_rows(spark, docs, benchmark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "text", "taken"} <= set(out.columns)
    found = [i for i in ids(out) if i != "None"]
    assert "9" not in found and len(found) == len(set(found)) and set(found) <= {"1", "2", "3", "4", "7", "8"}
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_tables_of_a_job_go(spark, docs, monkeypatch):
    from traffic_signals.llm.common import own_tables, staged, table

    paths = []

    def exists(path):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    with pytest.raises(ZeroDivisionError), own_tables(spark):
        paths += staged(spark.range(3).toDF("n"), "mine").inputFiles()
        kept = table(spark.range(3).toDF("n"), "kept")
        1 / 0
    assert not exists(paths[0]) and exists(kept)
    assert staged(spark.range(3).toDF("n"), "free").count() == 3  # outside of a job nothing is deleted before the driver ends


def test_a_failing_stage_leaves_nothing(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a b c")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def first(spark, docs, sf_dir):
        return docs

    def second(spark, docs, sf_dir):
        seen.extend(docs.inputFiles())
        raise ValueError("on purpose")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", first), ("second", second)])
    with pytest.raises(ValueError, match="on purpose"):
        corpus_pipeline.run(spark, str(tmp_path))
    at = spark._jvm.org.apache.hadoop.fs.Path(seen[0])
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
