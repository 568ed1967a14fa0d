"""Aggregates over parsed lines and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import BUCKET_LABELS, FAMILY_LABELS
from .classify import provider_bucket, signal_family


def pass_counters(include_unknown: bool = False) -> list[Column]:
    """parsed, malformed, blank, skipped and queued of parsed lines (error) with a class, as aggregates; also for `DataFrame.observe`."""
    ok = F.col("error").isNull()
    keep = ok & (F.lit(include_unknown) | (F.col("class.provider") != "other"))
    return [
        F.count_if(ok).alias("parsed"), F.count_if(~ok & (F.col("error") != "empty_line")).alias("malformed"), F.count_if(F.col("error") == "empty_line").alias("blank"),
        F.count_if(ok & ~keep).alias("skipped"), F.count_if(keep).alias("queued"),
    ]


def pass_statistics(parsed: DataFrame, batch_size: int = 100, include_unknown: bool = False) -> DataFrame:
    """One row: parsed, malformed, blank, skipped, queued and batches of parsed lines with a class; partial sums, then one row."""
    return parsed.agg(*pass_counters(include_unknown)).withColumn("batches", F.ceil(F.col("queued") / batch_size).cast("long"))


def by_bucket(observations: DataFrame, *also: str) -> DataFrame:
    """Observations by provider bucket and signal family (and further columns); only what was seen has a row."""
    keyed = observations.select(provider_bucket(F.col("class.provider")).alias("bucket"), signal_family(F.col("class.agent_type")).alias("family"), *also)
    return keyed.groupBy("bucket", "family", *also).agg(F.count("*").alias("visits"))


def windowed_by_bucket(observations: DataFrame, window: str = "1 hour", late: str = "10 minutes", time: str = "observed_at") -> DataFrame:
    """The same for a stream, in tumbling windows of event time, late rows accepted up to the watermark."""
    keyed = observations.withWatermark(time, late).select(time, provider_bucket(F.col("class.provider")).alias("bucket"), signal_family(F.col("class.agent_type")).alias("family"))
    return keyed.groupBy(F.window(time, window), "bucket", "family").agg(F.count("*").alias("visits"))


def with_labels(rollup: DataFrame) -> DataFrame:
    """A rollup with bucket_label and family_label, the names for readers."""
    named = lambda c, labels: F.element_at(F.create_map(*(F.lit(x) for pair in labels.items() for x in pair)), F.col(c))
    return rollup.withColumns({"bucket_label": named("bucket", BUCKET_LABELS), "family_label": named("family", FAMILY_LABELS)})
