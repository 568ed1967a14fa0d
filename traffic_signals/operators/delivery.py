"""Delivery as data: batches, envelopes, signatures, outcomes and retry schedules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import written
from .privacy import hmac_sha256

BATCH_SIZE = 100
MAX_RETRIES, BASE_MS, MAX_MS = 2, 100, 1000


def canonical_json(df: DataFrame) -> DataFrame:
    """df with event: the JSON body of an observation with the contract's names; absent parts are left out."""
    f = F.col
    request = F.struct(f("host"), f("path"), f("search"), f("method"), f("user_agent").alias("userAgent"), f("referer"))
    known = F.struct(f("class.provider").alias("provider"), f("class.agent_type").alias("agentType"), f("class.confidence").alias("confidence"), F.array("class.matched_by").alias("matchedBy"))
    place = F.when(f("country").isNotNull() | f("region").isNotNull(), F.struct("country", "region"))
    ip = F.when(f("ip_hash").isNotNull(), F.struct(
        f("ip_hash.algorithm").alias("algorithm"), f("ip_hash.value").alias("value"), f("ip_hash.key_id").alias("keyId"), f("ip_hash.truncated_bits").alias("truncatedBits"),
        f("ip_hash.original_ip_retention").alias("originalIpRetention")))
    body = F.struct(
        f("schema_version").alias("schemaVersion"), f("event_kind").alias("eventKind"), f("source_provider").alias("sourceProvider"), f("observed_at").alias("observedAt"), request.alias("request"),
        known.alias("providerClassification"), place.alias("location"), ip.alias("ipHash"),
        F.struct(f("integration_kind").alias("kind"), f("integration_name").alias("name"), f("request_id").alias("requestId")).alias("integration"))
    return df.withColumn("event", F.to_json(body))


def probe_json(df: DataFrame) -> DataFrame:
    """df with event: the JSON body of a setup probe."""
    f = F.col
    request = F.struct(f("host"), f("path"), f("search"), f("method"), f("user_agent").alias("userAgent"), f("referer"))
    body = F.struct(
        f("schema_version").alias("schemaVersion"), f("event_kind").alias("eventKind"), f("source_provider").alias("sourceProvider"), f("observed_at").alias("observedAt"),
        F.struct(f("probe_id").alias("id"), f("probe_token").alias("token")).alias("probe"), request.alias("request"),
        F.struct(f("integration_kind").alias("kind"), f("integration_name").alias("name"), f("request_id").alias("requestId")).alias("integration"))
    return df.withColumn("event", F.to_json(body))


def probe_envelopes(probes: DataFrame) -> DataFrame:
    """probes with body: each probe is posted alone."""
    return probe_json(probes).withColumn("body", F.concat(F.lit('{"probe":'), "event", F.lit("}")))


def numbered(df: DataFrame, source: str, order: list[str], column: str) -> DataFrame:
    """df with column: the rows of each source numbered from 0 by `order`, however many rows a source has.

    Rows are dealt by ranges of (source, order), so a large source lies in many partitions. A row's number is its place in its partition
    plus the rows of its source in earlier partitions; the prefix sums run over one row for each source and partition. The ranges are
    drawn from a sample, so they are written once, not drawn again by the second reader. The rows are written before that, as the
    sample is a pass of its own over them, which would do all the work that they are made by a second time.
    """
    ranged = written(written(df, "rows").repartitionByRange(source, *order).withColumn("__part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy(F.col(source).alias("__source"), F.col("__part").alias("__of")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__source").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__source", "__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(source, "__part").orderBy(*order)) - 1
    placed = ranged.withColumn("__own", own).join(counts, F.col(source).eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__of")))
    return placed.select(*df.columns, (F.col("__own") + F.col("__before")).alias(column))


def assign_batches(df: DataFrame, source: str, order: list[str], size: int = BATCH_SIZE) -> DataFrame:
    """df with batch_no and position: consecutive chunks of `size` rows of each source, the last one short. A source is a file or a shard."""
    if size < 1:
        raise ValueError("a batch size must be a positive integer")
    n = F.col("__n")
    return numbered(df, source, order, "__n").withColumns({"batch_no": F.floor(n / size).cast("int"), "position": (n % size).cast("int")}).drop("__n")


def envelopes(batched: DataFrame, source: str, event: str = "event", also: str | None = None) -> DataFrame:
    """(source, batch_no, events, body): one ready-to-post body for each batch. No rows, no envelope. also: a further column that is
    the same for all rows of a source."""
    more = [F.first(also).alias(also)] if also else []
    g = batched.groupBy(source, "batch_no").agg(F.array_sort(F.collect_list(F.struct("position", F.col(event).alias("e")))).alias("all"), *more)
    body = F.concat(F.lit('{"events":['), F.array_join(F.transform("all", lambda x: x.e), ","), F.lit("]}"))
    return g.select(source, "batch_no", F.size("all").alias("events"), body.alias("body"), *([also] if also else []))


def signature(timestamp: Column, body: Column, ipad: Column, opad: Column) -> Column:
    return F.concat(F.lit("sha256="), hmac_sha256(F.concat_ws(".", timestamp, body), ipad, opad))


def outcomes(attempts: DataFrame) -> DataFrame:
    """attempts (status, null for a network error) with ok, auth_failure and retryable."""
    s = F.col("status")
    auth = F.coalesce(s.isin(401, 403), F.lit(False))
    return attempts.withColumns({
        "ok": F.coalesce(s.between(200, 299), F.lit(False)), "auth_failure": auth,
        "retryable": F.when(s.isNull(), True).otherwise((s.isin(408, 409, 425, 429) | (s >= 500)) & ~auth),
    })


def retry_schedule(attempts: DataFrame, retries: int = MAX_RETRIES, base_ms: int = BASE_MS, max_ms: int = MAX_MS) -> DataFrame:
    """attempts (attempt from 1, retryable) with next_delay_ms, null if there is no further attempt."""
    delay = F.least(F.lit(max_ms).cast("double"), base_ms * F.pow(F.lit(2.0), F.col("attempt") - 1)).cast("long")
    return attempts.withColumn("next_delay_ms", F.when(F.col("retryable") & (F.col("attempt") <= retries), delay))


def latest_attempts(attempts: DataFrame, batch: str = "batch_id") -> DataFrame:
    """(batch, attempts, status, ok): the last attempt of each batch."""
    last = F.max_by(F.struct("status", "ok"), "attempt")
    return attempts.groupBy(batch).agg(F.max("attempt").alias("attempts"), last.alias("last")).select(batch, "attempts", "last.status", "last.ok")


def due_batches(outbox: DataFrame, attempts: DataFrame, batch: str = "batch_id", retries: int = MAX_RETRIES, base_ms: int = BASE_MS, max_ms: int = MAX_MS) -> DataFrame:
    """outbox with attempt and delay_ms: the batches that are to be posted now, and how long after their last attempt.

    attempts: (batch, attempt from 1, status), all that has happened so far. A batch without an attempt is due at once. One whose last
    attempt has an outcome that can be tried again is due while attempts are left; any other is final and is not due.
    """
    last = latest_attempts(outcomes(attempts), batch).select(F.col(batch).alias("__batch"), "attempts", "status")
    judged = retry_schedule(outcomes(last.withColumnRenamed("attempts", "attempt")), retries, base_ms, max_ms)
    final = judged.where(F.col("next_delay_ms").isNull()).select("__batch")
    again = judged.where(F.col("next_delay_ms").isNotNull()).select("__batch", "attempt", "next_delay_ms")
    open_ = outbox.join(final, F.col(batch) == F.col("__batch"), "left_anti")
    due = open_.join(again, F.col(batch) == F.col("__batch"), "left")
    return due.select(*outbox.columns, (F.coalesce("attempt", F.lit(0)) + 1).cast("int").alias("attempt"), F.coalesce("next_delay_ms", F.lit(0)).alias("delay_ms"))


def delivered(outbox: DataFrame, post: Callable[[DataFrame], DataFrame], batch: str = "batch_id", retries: int = MAX_RETRIES) -> DataFrame:
    """The ledger of all attempts, (batch, attempt, delay_ms, status, ok, auth_failure, retryable), after rounds in which whatever is due is posted.

    post: due batches with their attempt -> the same rows with status (null for a network error). Each round's answers are written before
    the next is planned, so that nothing is posted twice to find out what came back. There are `retries` + 1 rounds at most.
    """
    spark = outbox.sparkSession
    ledger = spark.createDataFrame([], outbox.select(batch, F.lit(1).alias("attempt"), F.lit(0).cast("long").alias("delay_ms"), F.lit(0).alias("status")).schema)
    for _ in range(retries + 1):
        due = due_batches(outbox, ledger.select(batch, "attempt", "status"), batch, retries)
        answers = written(post(due).select(batch, "attempt", "delay_ms", F.col("status").cast("int").alias("status")), "answers")
        ledger = ledger.unionByName(answers)
        if answers.isEmpty():
            break
    return outcomes(ledger)
