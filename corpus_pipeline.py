"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from traffic_signals.llm import decontaminate, line_quality, mixing, near_duplicates, personal_data
from traffic_signals.llm.common import delete_table, own_tables, read, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labels of the documents that are there."""
    return line_quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_duplicates.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts are replaced; every document stays."""
    return personal_data.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of words that it takes from each."""
    return mixing.mixed_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicate), ("decontamination", decontamination), ("privacy", privacy), ("mixture", mixture)]

#: The classifier and the sanitiser can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: doc_id, text, lang, source, n_chars, then size, source_size, target and taken of the mix.

    Null and empty texts, very long ones, ties, repeated rows and further columns of any name are handled as the operators' docstrings
    say; an empty table gives no rows. What a stage has written for itself, and its input, is deleted once its output is written, or
    once it has failed; another pipeline in the same driver keeps its own.
    """
    docs, path = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        try:
            with own_tables(spark):
                out = stage(spark, docs, sf_dir)
                written = table(out, name)
        finally:
            if path:
                delete_table(spark, path)
        docs, path = spark.read.schema(out.schema).parquet(written), written
    return docs
