"""Scan and parse CDN real-time log records: tab-separated lines, also inside base64 stream envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import absent, epoch_seconds, filled, http_method, iso_timestamp, kept_apart
from ..functions.schema import CLOUDFRONT_FIELDS


def read_cloudfront(spark: SparkSession, paths: str | list[str], stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).text(paths, lineSep="\n").select("value", F.col("_metadata.file_path").alias("source_file"))


def decode_envelopes(df: DataFrame, data: str = "data") -> DataFrame:
    """df with one row for each non-blank line of its base64 data, as value; undecodable data give a row with a null value."""
    text = F.try_to_binary(data, F.lit("base64")).cast("string")
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: filled(x).isNotNull())
    return df.select("*", F.explode(F.coalesce(lines, F.array(F.lit(None).cast("string")))).alias("value")).drop(data)


def _search(c: Column) -> Column:
    c = F.nullif(absent(c), F.lit("-"))
    return F.when(F.startswith(c, F.lit("?")), c).otherwise(F.concat(F.lit("?"), c))


def parse_cloudfront(df: DataFrame, fields: list[str] = CLOUDFRONT_FIELDS) -> DataFrame:
    """df (value, ...) with observed_at, client_ip, method, host, path, search, request_id, user_agent, referer, country and `error`.

    error is null, or undecodable, empty_line, wrong_field_count, missing_timestamp, missing_host or missing_path.
    """
    own = df.columns
    d = df.withColumn("__line", F.regexp_replace("value", r"\r?\n\z", "")).withColumn("__parts", F.split("__line", "\t", -1))

    def get(name: str) -> Column:
        return F.get("__parts", F.lit(fields.index(name))) if name in fields else F.lit(None).cast("string")

    d = d.withColumns({f"__{k}": F.when(~get(k).isin("", "-"), get(k)) for k in [*CLOUDFRONT_FIELDS, "x-host-header"]})
    f = lambda name: F.col(f"`__{name}`")
    full = lambda c: F.when(filled(c).isNotNull(), c)
    stamp = f("timestamp")
    d = d.withColumns({
        "__at": F.when(stamp.rlike(r"^[0-9]+(?:\.[0-9]+)?\z"), epoch_seconds(stamp.try_cast("double"))).otherwise(iso_timestamp(stamp)),
        "__host": F.coalesce(full(f("cs-host")), full(f("x-host-header"))), "__pieces": F.split(f("cs-uri-stem"), r"\?", -1),
    })
    error = (
        F.when(F.col("value").isNull(), "undecodable").when(filled(F.col("__line")).isNull(), "empty_line").when(F.size("__parts") != len(fields), "wrong_field_count")
        .when(full(f("cs-uri-stem")).isNull(), "missing_path").when(F.col("__at").isNull(), "missing_timestamp").when(F.col("__host").isNull(), "missing_host")
    )
    # Only the first two pieces of the stem count: what follows a second question mark is dropped.
    d = d.withColumns({"error": error, "__query": F.coalesce(f("cs-uri-query"), F.get("__pieces", F.lit(1)))})
    entry = {
        "observed_at": F.col("__at"), "client_ip": f("c-ip"), "method": http_method(f("cs-method")), "host": F.col("__host"), "path": F.coalesce(absent(F.get("__pieces", F.lit(0))), F.lit("/")),
        "search": _search(F.col("__query")), "request_id": f("x-edge-request-id"), "user_agent": f("cs-user-agent"), "referer": f("cs-referer"),
        "country": F.when(f("c-country").rlike(r"^[A-Z]{2}\z"), f("c-country")),
    }
    return kept_apart(d, F.struct("error", *(F.when(F.col("error").isNull(), c).alias(k) for k, c in entry.items())), own)
