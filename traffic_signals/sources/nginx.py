"""Scan and parse nginx access logs: combined text lines and JSON lines.

A parsed line is one row with the columns of ENTRY and an error code, exactly one of `error` and `observed_at` being null. Malformed
lines never stop a job; `split_errors` puts them aside.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import dash_null, epoch_seconds, http_method, iso_timestamp, jtrim, kept_apart, last_wins, leading_int

ENTRY = ["format", "remote_address", "observed_at", "host", "method", "path", "search", "protocol", "status", "bytes_sent", "referer", "user_agent"]

# The combined log format and its time.
LINE = r'^(\S+)\s+\S+\s+\S+\s+\[([^\]]+)\]\s+"([^"]*)"\s+([0-9]{3}|-)\s+(\S+)(?:\s+"([^"]*)"\s+"([^"]*)")?'
TIME = r"^[0-9]{2}/(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)/[0-9]{4}:[0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}\z"

# The keys of JSON lines; the first one present counts.
KEYS = {
    "remote_address": ["remote_addr", "remoteAddress", "ip"],
    "time": ["time_iso8601", "timestamp", "time", "@timestamp"],
    "msec": ["msec"],
    "host": ["host", "http_host", "server_name"],
    "request": ["request"],
    "method": ["request_method", "method"],
    "uri": ["request_uri", "uri", "path"],
    "protocol": ["server_protocol", "protocol"],
    "status": ["status", "status_code"],
    "bytes_sent": ["body_bytes_sent", "bytes_sent"],
    "referer": ["http_referer", "referer", "referrer"],
    "user_agent": ["http_user_agent", "user_agent"],
}


def read_nginx(spark: SparkSession, paths: str | list[str], stream: bool = False) -> DataFrame:
    """(value, source_file): one row a line, a trailing carriage return removed. Blank lines are kept and counted later.

    Only lines that a newline ends count, so the half-written tail of a growing file is no row. A stream can't look at a whole file; its
    rows keep file_size and the carriage return, and each micro-batch goes through `complete_lines`.
    """
    raw = (spark.readStream if stream else spark.read).text(paths, lineSep="\n")
    raw = raw.select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("file_size"))
    return raw if stream else complete_lines(raw)


#: File name ends of compressed files, whose size tells nothing about their lines; they are whole as they are.
COMPRESSED = r"(?i)\.(?:gz|bz2|zst|snappy|lz4|deflate|xz)\z"


def complete_lines(raw: DataFrame) -> DataFrame:
    """raw (value, source_file, file_size, ...) without the last line of each file that doesn't end with a newline, and without file_size.

    Lines and their newlines make up a file's size, less the three bytes of a byte order mark that the reader drops. So one aggregate
    with a row a file tells which files have such a tail, and only those files' last rows are joined away. Rows are numbered by
    partition and place, alike in both passes over the same scan, and the last row of a file has its greatest number.
    """
    numbered = raw.withColumn("__row", F.monotonically_increasing_id())
    sizes = numbered.groupBy(F.col("source_file").alias("__file")).agg(F.sum(F.octet_length("value").cast("long") + 1).alias("__read"), F.max("file_size").alias("__size"), F.max("__row").alias("__last"))
    open_ended = sizes.where(~F.col("__file").rlike(COMPRESSED) & (F.col("__read") - F.col("__size")).isin(1, -2)).select("__file", "__last")
    kept = numbered.join(open_ended, (F.col("source_file") == F.col("__file")) & (F.col("__row") == F.col("__last")), "left_anti")
    return kept.drop("__row", "file_size").withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def origin_form(target: Column) -> Column:
    """A request target without scheme and authority."""
    return F.regexp_replace(target, r"^(?i:[a-z][a-z0-9+.-]*)://[^/?#]+", "")


def target_path(rest: Column) -> Column:
    """Path of a target in origin form; `/` if empty."""
    return F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^?]*", 0), r"^(?!/)", "/")


def target_search(rest: Column) -> Column:
    """Search of a target in origin form with its `?`, or null."""
    return F.when(F.contains(rest, F.lit("?")), F.regexp_extract(rest, r"(?s)\?.*", 0))


def nginx_time(c: Column) -> Column:
    return F.when(c.rlike(TIME), F.try_to_timestamp(c, F.lit("dd/MMM/yyyy:HH:mm:ss xx")))


def request_parts(request: Column) -> Column:
    """The words of a request line, or null if it has fewer than two."""
    parts = F.split(jtrim(request), r"\s+")
    return F.when((request != "-") & (F.size(parts) >= 2), parts)


#: Stands between the groups of LINE, none of which can hold it: each lacks the quote, the space or the bracket.
BETWEEN = '" ]'


def line_groups(text: Column) -> Column:
    """A blank and the seven groups of LINE, by one pass over a trimmed text; groups that take no part are empty. A text that LINE does
    not match has no blank in front."""
    every = BETWEEN.join([" ", *(f"${i}" for i in range(1, 8))])
    return F.split(F.regexp_replace(text, LINE + r"(?s:.*)\z", every), re.escape(BETWEEN), 8)


def found(value: Column, wanted: list[str]) -> Column:
    """array<struct<type, text, full>>: for each wanted entry of KEYS, the first of its keys that a JSON object has, whatever its value:
    later keys don't stand in for null, blank or `-`, as a JSON null is a VARIANT that is not null. full is the trimmed text of a string,
    null for those. What follows the look-up is one function over the values, so that it isn't generated for each of them."""
    own = lambda keys: F.coalesce(*(F.try_variant_get(value, f"$['{k}']", "variant") for k in keys))
    typed = lambda v: F.struct(F.schema_of_variant(v).alias("type"), F.try_variant_get(v, "$", "string").alias("text"))
    full = lambda x: F.struct(x["type"].alias("type"), x["text"].alias("text"), dash_null(F.when(is_text(x), x["text"])).alias("full"))
    return F.transform(F.transform(F.array(*(own(KEYS[k]) for k in wanted)), typed), full)


def is_text(x: Column) -> Column:
    return F.coalesce(x["type"] == "STRING", F.lit(False))


def optional_int(x: Column) -> Column:
    """From a present value: an integral number, or the integer that a string starts with."""
    text, number = x["text"], x["text"].try_cast("double")
    whole = x["type"].rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)") & (number == F.floor(number))
    return F.when(is_text(x), F.when(text != "-", leading_int(text))).when(whole, number.cast("bigint"))


#: Which entries of KEYS a column of ENTRY is read from, besides those that every line needs.
NEEDED = ("time", "msec", "request", "method", "uri")
READ_FROM = {"remote_address": "remote_address", "host": "host", "protocol": "protocol", "status": "status", "bytes_sent": "bytes_sent", "referer": "referer", "user_agent": "user_agent"}


def parse_nginx(df: DataFrame, format: str = "auto", default_host: str | None = None, columns: list[str] = ENTRY) -> DataFrame:
    """df (value, ...) with the given columns of ENTRY and `error`: null, or empty_line, malformed_line, malformed_json,
    malformed_request, missing_timestamp, unsupported_format. All entry columns of a bad line are null. format is auto, common or json.

    Steps are projections of their own, so that what several of them read is computed once. Columns that nobody asks for are not
    computed; the plan can't tell, as the entry comes out of `inline`.
    """
    known, own = format in ("auto", "common", "json"), df.columns
    d = last_wins(df).withColumn("__line", jtrim(F.coalesce("value", F.lit(""))))
    json = F.lit(True) if format == "json" else F.startswith("__line", F.lit("{")) if format == "auto" else F.lit(False)
    d = d.withColumn("__json", json & (F.col("__line") != ""))
    j, line = F.col("__json"), F.col("__line")
    none = F.lit(None).cast("string")
    text = {k: none for k in KEYS}
    value = {k: F.struct(none.alias("type"), none.alias("text")) for k in KEYS}
    group = {i: none for i in range(1, 8)}
    is_object, fits = F.lit(False), F.lit(False)
    if format != "common":
        # A JSON line is parsed inside brackets, so that anything after the object makes the whole malformed.
        d = d.withColumn("__all", F.when(j, F.try_parse_json(F.concat(F.lit("["), "__line", F.lit("]")))))
        d = d.withColumn("__v", F.try_variant_get("__all", "$[0]", "variant"))
        d = d.withColumn("__object", F.schema_of_variant("__v").startswith("OBJECT") & F.try_variant_get("__all", "$[1]", "variant").isNull())
        wanted = [k for k in KEYS if k in (*NEEDED, *(READ_FROM.get(c) for c in columns))]
        d = d.withColumn("__found", F.when(F.col("__object"), found(F.col("__v"), wanted)))
        value |= {k: F.get("__found", F.lit(i)) for i, k in enumerate(wanted)}
        text |= {k: value[k]["full"] for k in wanted}
        is_object = F.coalesce("__object", F.lit(False))
    if format != "json":
        d = d.withColumn("__cut", F.when(~j, line_groups(line)))
        d = d.withColumn("__groups", F.when(F.get("__cut", F.lit(0)) == " ", F.col("__cut")))
        own_group = {i: F.get("__groups", F.lit(i)) for i in group}
        group = {i: dash_null(g) if i in (1, 6, 7) else g for i, g in own_group.items()}  # address, referer, user agent
        fits = F.col("__groups").isNotNull()
    d = d.withColumn("__req", request_parts(F.when(j, text["request"]).otherwise(group[3])))
    split = ~j | text["request"].isNotNull()  # a present but malformed request does not fall through
    msec = value["msec"]["text"].try_cast("double")
    at_json = F.when(text["time"].isNotNull(), iso_timestamp(text["time"])).otherwise(epoch_seconds(msec))
    part = lambda n, key: F.when(split, F.get("__req", F.lit(n))).otherwise(text[key])
    d = d.withColumns({"__target": origin_form(part(1, "uri")), "__method": part(0, "method"), "__at": F.when(j, at_json).otherwise(nginx_time(group[2]))})
    lost = F.col("__target").isNull() | F.col("__method").isNull()
    error = F.when(line == "", "empty_line").when(F.lit(not known), "unsupported_format").when(j & ~is_object, "malformed_json").when(~j & ~fits, "malformed_line")
    d = d.withColumn("error", error.when(lost, "malformed_request").when(F.col("__at").isNull(), "missing_timestamp"))
    either = lambda key, n: F.when(j, text[key]).otherwise(group[n])
    # As a function of an array, which adds little to generated methods.
    number = lambda key, n: F.when(j, F.get(F.transform(F.array(value[key]), optional_int), F.lit(0))).otherwise(leading_int(group[n]))
    fields = {
        "format": lambda: F.when(j, "json").otherwise("common"), "remote_address": lambda: either("remote_address", 1), "observed_at": lambda: F.col("__at"),
        "host": lambda: F.coalesce(text["host"], F.lit(default_host).cast("string")), "method": lambda: http_method(F.col("__method")), "path": lambda: target_path(F.col("__target")),
        "search": lambda: target_search(F.col("__target")), "protocol": lambda: part(2, "protocol"), "status": lambda: number("status", 4).cast("int"), "bytes_sent": lambda: number("bytes_sent", 5),
        "referer": lambda: either("referer", 6), "user_agent": lambda: either("user_agent", 7),
    }
    entry = F.struct("error", *(F.when(F.col("error").isNull(), fields[k]()).alias(k) for k in ENTRY if k in columns))
    return kept_apart(d, entry, own)


def split_errors(parsed: DataFrame, mode: str = "PERMISSIVE") -> tuple[DataFrame, DataFrame]:
    """(entries, dead letters). FAILFAST raises on the first bad line instead."""
    if mode == "FAILFAST":
        stop = F.raise_error(F.concat(F.lit("malformed log line: "), F.col("error"))).cast("boolean")
        return parsed.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(stop)), parsed.where(F.lit(False))
    return parsed.where(F.col("error").isNull()).drop("error"), parsed.where(F.col("error").isNotNull()).select("value", "error")
