"""Continuous jobs. All parsing and classification is stateless, so the batch functions serve streams unchanged.

Sources are folders into which files are moved under new names. A micro-batch is committed after its outputs are written; after a
failure it runs again, and outputs keyed by the batch id replace what the failed run has left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.classify import with_request_class
from ..operators.delivery import BATCH_SIZE
from ..operators.rollups import pass_counters, windowed_by_bucket
from ..plans.jobs import cloudfront_to_observations, delivery_job, envelopes_to_observations, nginx_to_observations
from ..sources.cloudfront import read_cloudfront
from ..sources.nginx import complete_lines, parse_nginx, read_nginx
from ..sources.sinks import write_outbox

BatchFunction = Callable[[DataFrame, int], None]
#: The name under which a stream reports its pass counters.
PASS = "pass_statistics"
ENVELOPES = "shard string, sequence_number string, data string"


def batch_writer(path: str, *also: BatchFunction) -> BatchFunction:
    """A foreachBatch function that writes each micro-batch to a folder of its own."""

    def write(df: DataFrame, batch_id: int) -> None:
        kept = df.persist()
        try:
            kept.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            for out in also:
                out(kept, batch_id)
        finally:
            kept.unpersist()

    return write


def _start(df: DataFrame, write: BatchFunction, checkpoint: str, every: str | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def stream_nginx(spark: SparkSession, source: str, sink: str, checkpoint: str, every: str | None = None, stats: str | None = None, **options: object) -> StreamingQuery:
    """nginx lines to observations; `every` is the polling interval, None takes what is there and ends.

    Lines that no newline ends are left out. stats: a folder that gets, for each micro-batch, the counters of all its lines (parsed,
    malformed, blank, skipped, queued), taken while the observations are written.
    """

    def run(lines: DataFrame, batch_id: int) -> None:
        lines = lines.persist()  # `complete_lines` reads the lines twice
        try:
            counters = Observation(PASS)
            observed = nginx_to_observations(complete_lines(lines), counted=counters, **options)
            observed.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            if stats:
                row = counters.get  # the write has filled it
                spark_ = lines.sparkSession
                spark_.createDataFrame([tuple(row[k] for k in COUNTERS)], [*COUNTERS]).coalesce(1).write.mode("overwrite").json(f"{stats}/batch_id={batch_id}")
        finally:
            lines.unpersist()

    return _start(read_nginx(spark, source, stream=True), run, checkpoint, every)


COUNTERS = ("parsed", "malformed", "blank", "skipped", "queued")


class PassListener(StreamingQueryListener):
    """Keeps the pass counters that streams report, by stream name and batch, and hands each on as it comes."""

    def __init__(self, also: Callable[[str, int, dict], None] | None = None):
        self.seen: dict[tuple[str, int], dict[str, int]] = {}
        self.also = also

    def onQueryStarted(self, event: QueryStartedEvent) -> None: ...

    def onQueryIdle(self, event: QueryIdleEvent) -> None: ...

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None: ...

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        row = event.progress.observedMetrics.get(PASS)
        if row is not None:
            key = (event.progress.name or str(event.progress.id), event.progress.batchId)
            self.seen[key] = row.asDict()
            if self.also:
                self.also(*key, self.seen[key])


def stream_cloudfront(spark: SparkSession, source: str, sink: str, checkpoint: str, every: str | None = None, **options: object) -> StreamingQuery:
    return _start(cloudfront_to_observations(read_cloudfront(spark, source, stream=True), **options), batch_writer(sink), checkpoint, every)


def stream_envelopes(
    spark: SparkSession, source: str, outbox: str, checkpoint: str, keys: DataFrame, site: str, sent_at: Callable[[int], str], post: BatchFunction | None = None, size: int = BATCH_SIZE,
    every: str | None = None, **options: object,
) -> StreamingQuery:
    """Stream envelopes (JSON lines: shard, sequence_number and base64 data) to signed bodies in the outbox, one folder a micro-batch.

    keys: what `key_table` gives; site names the key of all records of the stream. sent_at: the time stamp of a micro-batch by its
    number, so that a replay signs the same bytes. post: sends a micro-batch's bodies; what it raises fails the micro-batch, which is
    then neither committed nor lost: the next start runs it again, under the same number and into the same folder. An envelope is
    delivered at least once, and its rows are numbered by shard and sequence number, so that a replay cuts the same batches.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        observed = envelopes_to_observations(df.withColumn("own_site", F.lit(site)), carry=("shard", "sequence_number", "own_site"), **options)
        bodies = delivery_job(observed, "shard", ["sequence_number", "event"], keys, "own_site", F.lit(sent_at(batch_id)), size)
        write_outbox(bodies, outbox, batch_id)
        if post:
            post(df.sparkSession.read.schema(bodies.schema).json(f"{outbox}/batch_id={batch_id}"), batch_id)

    return _start(spark.readStream.schema(ENVELOPES).json(source), run, checkpoint, every)


def stream_rollup(spark: SparkSession, source: str, sink: str, checkpoint: str, window: str = "1 hour", late: str = "10 minutes", every: str | None = None) -> StreamingQuery:
    """Visits by bucket and family in windows of event time; a window is written once the watermark has passed it.

    The stream reports its pass counters under PASS; a `PassListener` of the session sees them. A stateful stream can't hold a tail back:
    files are moved into the source when they are complete.
    """
    lines = read_nginx(spark, source, stream=True).withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    classed = with_request_class(parse_nginx(lines)).observe(PASS, *pass_counters())
    counted = windowed_by_bucket(classed.where(F.col("error").isNull()), window, late)
    return _start(counted.select(F.col("window.start").alias("start"), "bucket", "family", "visits"), batch_writer(sink), checkpoint, every)
