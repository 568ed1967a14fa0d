"""Tables that a job writes for itself: to cut lineage where a plan must not be computed twice."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str = "scratch") -> str:
    """A new path in the folder that spark.checkpoint.dir names; with a local master only, a temporary folder where it is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='spark-')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written and read again: a lost executor costs a reread, never the work before it, and every reader sees the same rows. The table
    goes when the driver ends."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    at, fs = _file(df.sparkSession, path)
    fs.deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _file(spark, path)
    fs.delete(at, True)


def _file(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch_folder(spark: SparkSession, name: str = "scratch") -> Iterator[str]:
    """A path that is deleted at the end, also after a failure."""
    path = scratch(spark, name)
    try:
        yield path
    finally:
        delete(spark, path)
