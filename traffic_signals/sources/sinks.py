"""Sinks: observations, dead letters, delivery outbox, side outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _batch_path(path: str, batch_id: int | None) -> tuple[str, str]:
    """Folder and mode: a batch owns a folder, which a replay of it replaces whole; without a batch rows are appended."""
    return (path, "append") if batch_id is None else (f"{path}/batch_id={batch_id}", "overwrite")


def write_observations(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Parquet by day, so that readers prune by date; with batch_id also by batch, which a replay replaces."""
    folder, mode = _batch_path(path, batch_id)
    df.withColumn("observed_date", F.substring("observed_at", 1, 10)).write.mode(mode).partitionBy("observed_date").parquet(folder)


def write_dead_letters(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """value and error as Parquet, by error; with batch_id also by batch, which a replay replaces."""
    folder, mode = _batch_path(path, batch_id)
    df.write.mode(mode).partitionBy("error").parquet(folder)


def write_outbox(envelopes: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Ready-to-post bodies as JSON lines; with batch_id in a folder of their own, which a replay replaces."""
    folder, mode = _batch_path(path, batch_id)
    envelopes.write.mode(mode).json(folder)


def side_output(df: DataFrame, *outputs: Callable[[DataFrame], None]) -> None:
    """Hand the same rows to several outputs, computing them once."""
    kept = df.persist()
    try:
        for out in outputs:
            out(kept)
    finally:
        kept.unpersist()
