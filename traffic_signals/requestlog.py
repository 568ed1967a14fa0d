"""A request log derived from the tables `events` and `pages`: what the queries of the catalog run on.

Every event is a request for a page. Its user agent, referer and further query come from the lists below by the event's id. The log
is plain columns; `common_lines`, `json_lines` and so on render it as raw lines, which the parsers then read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/126.0 Safari/537.36", "Mozilla/5.0 (compatible; OAI-SearchBot/1.0)", "Mozilla/5.0 (compatible; GPTBot/1.2)",
    "Mozilla/5.0 ChatGPT-User/1.0", "Claude-SearchBot/1.0", "Claude-User/1.0", "Mozilla/5.0 (compatible; ClaudeBot/1.0)", "PerplexityBot/1.0", "Perplexity-User/1.0", "Google-Agent; test",
    "Google-NotebookLM/1.0", "GoogleOther-Image/1.0", "Mozilla/5.0 (compatible; Googlebot/2.1)", "meta-externalagent/1.1", "facebookexternalhit/1.1", "Bytespider; spider", "xGPTBot/1.0",
    "GPTBot_x", "gptbot", "-", "curl/8.5.0", "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Safari/605.1.15", "Mozilla/5.0 (X11; Linux x86_64) Firefox/128.0",
]
REFERERS = [
    "-", "https://chatgpt.com/", "https://www.google.com/search?q=x", "https://claude.ai/chat/1", "https://www.perplexity.ai/search#a", "https://gemini.google.com/app",
    "https://copilot.microsoft.com/", "https://example.com/page?utm=1", "https://meta.ai", "https://grok.com/", "https://chat.mistral.ai/chat", "https://poe.com/x", "https://platform.openai.com/docs",
    "https://chatgpt.com?x=1", "https://evil.com?x.chatgpt.com/", "http://bing.com/chat?q=1", "-", "https://news.example.org/a?b=c#d", "https://www.google.de/url?sa=t",
]
QUERIES = ["", "utm_source=chatgpt.com", "source=ChatGPT&x=1", "q=chatgpt", "utm_source=https%3A%2F%2Fchat.openai.com%2F", "utm_source=cha%3Atgpt.com", "utm%5Fsource=www.chatgpt.com", "a=b+c&utm_source=news", "b=%zz", "&&x", "token=secret&page=2"]
METHODS = ["GET", "get", "POST", "HEAD", "PUT", "PATCH", "DELETE", "OPTIONS", "TRACE"]
STATUSES = [200, 200, 200, 304, 404, 500, 301]


def _pick(values: list, step: int = 1) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(F.col("event_id") / step) % len(values) + 1).cast("int"))


#: Rows of a task, at most about. What they are rendered to and parsed into is many times as wide, so tasks are cut by rows: by the bytes of
#: the narrow rows a task would get millions of them, and what it then sorts would grow with the table.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """As many tasks for each core, at least one, that none has more than TASK_ROWS."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-rows // (cores * TASK_ROWS)))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, stamp, host, path, search, method, status, bytes, ip, user_agent, referer): one row for each event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    n = pages.count()
    # Both sides are dealt, as either may be the one that is broadcast. A join that shuffles makes spark.sql.shuffle.partitions tasks at least.
    tasks = tasks_for(spark, events.count())
    log = events.withColumn("page_id", F.col("event_id") % n).repartition(tasks, "page_id").join(pages.repartition(tasks, "page_id"), "page_id")
    query, own = _pick(QUERIES, 3), F.regexp_extract("url", r"\?([^#]*)", 1)
    search = F.array_join(F.filter(F.array(own, query), lambda x: x != ""), "&")
    return log.select(
        "event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("stamp"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host"),
        F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1).alias("path"), F.when(search != "", F.concat(F.lit("?"), search)).alias("search"), _pick(METHODS, 2).alias("method"),
        _pick(STATUSES).alias("status"), (F.col("event_id") * 37 % 50_000).alias("bytes"), F.concat_ws(".", F.lit("10"), F.col("event_id") % 251, F.col("event_id") % 13, F.col("event_id") % 7).alias("ip"),
        F.nullif(_pick(USER_AGENTS), F.lit("-")).alias("user_agent"), F.nullif(_pick(REFERERS, 5), F.lit("-")).alias("referer"),
    )


def _or_dash(c: str) -> Column:
    return F.coalesce(c, F.lit("-"))


def target() -> Column:
    return F.concat("path", F.coalesce("search", F.lit("")))


def common_lines(log: DataFrame) -> DataFrame:
    line = F.format_string('%s - - [%s] "%s %s HTTP/1.1" %s %s "%s" "%s"', "ip", F.date_format("stamp", "dd/MMM/yyyy:HH:mm:ss xx"), "method", target(), F.col("status").cast("string"), F.col("bytes").cast("string"), _or_dash("referer"), _or_dash("user_agent"))
    return log.select("event_id", line.alias("value"))


def json_lines(log: DataFrame) -> DataFrame:
    """Two shapes by turns, with key aliases, a dash before a filled alias, numbers as strings, and epoch seconds."""
    iso = F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    one = F.to_json(F.struct(F.col("ip").alias("remote_addr"), iso.alias("time_iso8601"), F.col("host"), F.concat_ws(" ", "method", target(), F.lit("HTTP/2.0")).alias("request"), F.col("status"), F.col("bytes").cast("string").alias("body_bytes_sent"), F.lit("-").alias("http_referer"), F.lit("https://claude.ai/").alias("referer"), F.col("user_agent").alias("http_user_agent")))
    two = F.to_json(F.struct(F.unix_timestamp("stamp").alias("msec"), F.col("host").alias("server_name"), F.col("method").alias("request_method"), target().alias("uri"), F.concat(F.col("status").cast("string"), F.lit("x")).alias("status"), F.col("referer").alias("referrer"), F.col("user_agent")))
    return log.select("event_id", F.when(F.col("event_id") % 2 == 0, one).otherwise(two).alias("value"))


def mixed_lines(log: DataFrame) -> DataFrame:
    """Common and JSON lines with one of five faults in some."""
    good = common_lines(log).withColumnRenamed("value", "common").join(json_lines(log).withColumnRenamed("value", "json"), "event_id")
    k = F.col("event_id") % 11
    bad = F.when(k == 1, "not a log line").when(k == 2, "   ").when(k == 3, '{"host": "x", ').when(k == 4, '{"host": "x"} y').when(k == 5, '1.1.1.1 - - [01/Jan/2024:00:00:00 +0000] "-" 400 0')
    bad = bad.when(k == 6, '1.1.1.1 - - [01/MAY/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 5').when(k == 7, '{"request": "GET / HTTP/1.1"}')
    return good.select("event_id", F.coalesce(bad, F.when(F.col("event_id") % 2 == 0, F.col("json")).otherwise(F.col("common"))).alias("value"))


def cloudfront_lines(log: DataFrame) -> DataFrame:
    """Tab-separated records: ISO times or epoch seconds, embedded or separate queries; some with too few fields or no host."""
    k = F.col("event_id") % 10
    stamp = F.when(k < 5, F.date_format("stamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.concat(F.unix_timestamp("stamp").cast("string"), F.lit(".125")))
    stem = F.when(k == 3, F.concat("path", F.coalesce("search", F.lit("")), F.lit("?again=1"))).otherwise(F.col("path"))
    query = F.when(k == 3, "-").otherwise(F.coalesce(F.substring("search", 2, 1 << 20), F.lit("-")))
    host = F.when(k == 7, "-").otherwise(F.col("host"))
    country = F.element_at(F.array(*map(F.lit, ["US", "de", "FR", "-"])), (F.col("event_id") % 4 + 1).cast("int"))
    fields = [stamp, "ip", F.col("status").cast("string"), "method", F.lit("https"), host, stem, F.concat(F.lit("req-"), F.col("event_id").cast("string")), _or_dash("user_agent"), _or_dash("referer"), query, country]
    line = F.concat_ws("\t", *fields)
    return log.select("event_id", F.when(k == 9, F.lit("too\tfew")).otherwise(line).alias("value"))


def envelopes(lines: DataFrame, size: int = 5) -> DataFrame:
    """Base64 of `size` lines each, with a blank one between, keyed by shard."""
    g = lines.groupBy(F.floor(F.col("event_id") / size).alias("sequence_number")).agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias("all"))
    return g.select("sequence_number", F.base64(F.encode(F.array_join(F.transform("all", lambda x: x.value), "\r\n\n"), "UTF-8")).alias("data"))


def request_records(log: DataFrame) -> DataFrame:
    """Records of web runtimes: URL, method, headers in various cases, geo, request id; some are setup probes."""
    k = F.col("event_id") % 17
    probe = k == 5
    path = F.when(probe, F.lit("/__setup-probe")).otherwise(F.col("path"))
    url = F.concat(F.lit("https://"), "host", F.when(k == 2, ":8443").otherwise(""), path, F.coalesce("search", F.lit("")))
    pairs = F.array(
        F.struct(F.lit("User-Agent").alias("key"), F.concat(F.when(k == 1, " ").otherwise(""), F.coalesce("user_agent", F.lit(""))).alias("value")),
        F.struct(F.when(k == 3, "Referrer").otherwise("Referer").alias("key"), F.coalesce("referer", F.lit("")).alias("value")),
        F.struct(F.lit("X-Forwarded-For").alias("key"), F.concat("ip", F.lit(", 192.0.2.1")).alias("value")),
        F.struct(F.lit("X-Request-ID").alias("key"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("value")),
        F.struct(F.lit("x-vercel-ip-country").alias("key"), F.lit("us").alias("value")),
        F.struct(F.lit("CF-Ray").alias("key"), F.concat(F.lit("ray"), F.col("event_id").cast("string")).alias("value")),
        F.struct(F.lit("x-setup-probe").alias("key"), F.when(F.col("event_id") % 2 == 0, " TRUE").otherwise("off").alias("value")),
        F.struct(F.lit("x-probe-id").alias("key"), F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("value")),
        F.struct(F.lit("x-probe-token").alias("key"), F.when(F.col("event_id") % 3 == 0, " ").otherwise("t").alias("value")),
    )
    geo = F.struct(F.element_at(F.array(F.lit("DE"), F.lit("fr"), F.lit("x1")), (F.col("event_id") % 3 + 1).cast("int")).alias("country"), F.lit("BE").alias("region"))
    return log.select("event_id", url.alias("url"), "method", F.map_from_entries(pairs).alias("headers"), F.lit("203.0.113.9").alias("client_ip"), F.concat(F.lit("id"), F.col("event_id").cast("string")).alias("request_id"), geo.alias("geo"), F.col("stamp").alias("observed_at"))
