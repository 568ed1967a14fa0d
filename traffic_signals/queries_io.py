"""More queries of the catalog: URL forms, odd JSON, files, streams, sinks, delivery rounds and the parity of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import requestlog as rl
from .catalog import CF, CF_CLASSED, CF_ROWS, CLASSED, CODES, FAULT, LOG, METHOD, ORACLES, listed, pick, query, test_keys
from .functions.exprs import iso_millis
from .functions.rules import read_rules, rules_table, write_rules
from .functions.urls import authority, parse_url
from .operators import delivery
from .operators.classify import classify_referer, classify_user_agent, with_class, with_request_class
from .operators.privacy import Policy
from .operators.validate import validate_events
from .plans.jobs import nginx_to_observations, observe_requests
from .sources.cloudfront import parse_cloudfront, read_cloudfront
from .sources.nginx import parse_nginx, read_nginx, split_errors
from .sources.requests import tracked
from .sources.sinks import side_output, write_dead_letters, write_observations
from .streaming.jobs import stream_cloudfront, stream_envelopes, stream_nginx, stream_rollup
from .tables import scratch

# --- URLs and JSON ---------------------------------------------------------------------------------------------------------------


def _odd_urls(log: DataFrame) -> DataFrame:
    """URLs of thirteen kinds by turns: capitals and default ports, credentials, dot segments, back slashes, characters to be escaped,
    foreign hosts, fragments, addresses in other writings, and some that are none."""
    k, search, path, host = F.col("event_id") % 13, F.coalesce("search", F.lit("")), F.col("path"), F.col("host")
    made = [
        F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(":443"), path, search), F.concat(F.lit("https://u:p@"), host, F.lit(":8443/x/.."), path, search), F.concat(F.lit("http://"), host, F.lit(":080"), path),
        F.concat(F.lit("https://"), host, F.lit("/a/./b/../.."), path), F.concat(F.lit("https:\\\\"), host, F.translate(path, "/", "\\")), F.concat(F.lit("https://"), host, F.lit('/é "x"'), path, F.lit("?q=ü 'a'")),
        F.concat(F.lit("https://bücher."), host, path), F.concat(F.lit(" https://"), host, path, F.lit("?#frag\t")), F.concat(F.lit("http://0x7f."), (F.col("event_id") % 256).cast("string"), path),
        F.concat(F.lit("http://[0:0::"), F.lower(F.hex(F.col("event_id") % 65_535 + 1)), F.lit("]:8080"), path), F.concat(F.lit("https://"), host, F.lit(":70000"), path), F.concat(F.lit("https://"), host, path, F.lit("/%2e%2E/")),
        F.concat(F.lit("https://exa mple."), host, path),
    ]
    url = F.when(F.lit(False), "")
    for n, u in enumerate(made):
        url = url.when(k == n, u)
    return log.select("event_id", url.alias("url"))


@query(LOG + r""", kinds AS (SELECT event_id, host, path, search, event_id % 13 AS k FROM log)
SELECT event_id, CASE WHEN k IN (10, 12) THEN NULL WHEN k = 1 THEN host || ':8443' WHEN k = 6 THEN 'xn--bcher-kva.' || host WHEN k = 8 THEN '127.0.0.' || (event_id % 256)
    WHEN k = 9 THEN '[::' || format('{:x}', event_id % 65535 + 1) || ']:8080' ELSE host END AS host,
  CASE WHEN k IN (10, 12) THEN NULL WHEN k = 5 THEN '/%C3%A9%20%22x%22' || path WHEN k = 11 THEN coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') ELSE coalesce(nullif(path, ''), '/') END AS path,
  CASE WHEN k IN (0, 1) THEN search WHEN k = 5 THEN '?q=%C3%BC%20%27a%27' END AS search FROM kinds""")
def url_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, paths and searches by the URL standard."""
    parsed = _odd_urls(rl.request_log(spark, sf_dir)).select("event_id", parse_url(F.col("url")).alias("u"))
    return parsed.select("event_id", authority(F.col("u")).alias("host"), F.col("u.path").alias("path"), F.col("u.search").alias("search"))


def _repeating(log: DataFrame) -> DataFrame:
    """JSON lines in which keys repeat, nested ones too; every fifth names a key again with a dash or null."""
    again = F.when(F.col("event_id") % 5 == 0, F.lit(',"host":"-","http_user_agent":null')).otherwise(F.lit(""))
    head = F.lit('{"status":1,"host":"first.example","request":"GET /first HTTP/1.0","more":{"x":1,"x":[{"y":1,"y":{"z":1,"z":2}}]},"more":{"x":3},')
    rest = F.to_json(F.struct("host", F.col("status").cast("string").alias("status"), F.unix_timestamp("stamp").alias("msec"), F.concat_ws(" ", "method", rl.target(), F.lit("HTTP/2.0")).alias("request"), F.col("user_agent").alias("http_user_agent")))
    return log.select("event_id", F.concat(head, F.substring(rest, 2, 1 << 20), F.lit("")).alias("line"), again.alias("again")).select("event_id", F.concat(F.regexp_replace("line", r"\}\z", ""), F.col("again"), F.lit("}")).alias("value"))


@query(LOG + f" SELECT event_id, NULL AS error, CASE WHEN event_id % 5 <> 0 THEN host END AS host, path, search, {METHOD} AS method, status, 'HTTP/2.0' AS protocol, CASE WHEN event_id % 5 <> 0 THEN user_agent END AS user_agent FROM log")
def nginx_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of a repeated key counts."""
    p = parse_nginx(_repeating(rl.request_log(spark, sf_dir)), "json")
    return p.select("event_id", "error", "host", "path", "search", "method", "status", "protocol", "user_agent")


REPEATED = [
    ('"schemaVersion":0,"schemaVersion":1', ""), ('"schemaVersion":1,"schemaVersion":0', "schemaVersion must be >= 1"), ('"schemaVersion":1,"request":{"host":"h","path":"x","host":"","method":"GET"}', "host must be a non-empty string; request.path must start with /"),
    ('"schemaVersion":1,"request":[],"request":{"path":"x","path":"/","zz":1,"zz":2,"host":"h","method":"GET"}', "request.zz is not allowed"),
]


@query(LOG + f" SELECT event_id, {pick([m for _, m in REPEATED])} AS reason FROM log")
def validate_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with repeated keys, by what is wrong with the last values."""
    rest = '"eventKind":"request_observation","sourceProvider":"manual","observedAt":"2024-01-01T00:00:00Z","providerClassification":{"provider":"other","agentType":"other","confidence":0,"matchedBy":["other"]}'
    made = ["{" + rest + ',"request":{"host":"h","path":"/","method":"GET"},' + more + "}" for more, _ in REPEATED]
    records = rl.request_log(spark, sf_dir).select("event_id", F.element_at(F.array(*map(F.lit, made)), (F.col("event_id") % len(made) + 1).cast("int")).alias("event"))
    return validate_events(records).select("event_id", F.array_join("issues", "; ").alias("reason"))


# --- Files -----------------------------------------------------------------------------------------------------------------------


def _growing_files(log: DataFrame, path: str) -> None:
    """Files of about a thousand lines; every second one ends in the middle of a line."""
    blocks = rl.common_lines(log).withColumn("block", F.floor(F.col("event_id") / 1000))
    whole = blocks.groupBy("block").agg(F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("lines"))
    # The writer ends each row with the separator: the letter x at the end of a half-written line, or the newline of the last one.
    open_ended = whole.where(F.col("block") % 2 == 0).select("block", F.concat("lines", F.lit('\n1.1.1.1 - - [01/Jan/2024:00:00:00 +0000] "GET /half-written HTTP/1.1" 200 5 "-" "GPTBot/1.')).alias("value"))
    open_ended.write.partitionBy("block").option("lineSep", "x").text(f"{path}/open")
    whole.where(F.col("block") % 2 == 1).select("block", F.col("lines").alias("value")).write.partitionBy("block").text(f"{path}/ended")


@query(LOG + f" SELECT event_id // 1000 AS block, count(*) AS lines, count(DISTINCT {METHOD} || path) AS targets FROM log GROUP BY 1")
def nginx_complete_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that no newline ends are neither parsed nor counted as malformed."""
    root = scratch(spark)
    _growing_files(rl.request_log(spark, sf_dir), root)
    parsed = parse_nginx(read_nginx(spark, f"{root}/open").unionByName(read_nginx(spark, f"{root}/ended")))
    block = F.regexp_extract("source_file", "block=([0-9]+)", 1).cast("long")
    return parsed.groupBy(block.alias("block")).agg(F.count("*").alias("lines"), F.countDistinct(F.concat("method", "path")).alias("targets"))


@query(CF + " SELECT error, count(*) AS lines, min(CASE WHEN error IS NULL THEN request_id END) AS first_request, max(CASE WHEN error IS NULL THEN observed_at END) AS latest FROM cf GROUP BY 1")
def cloudfront_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDN log lines from files."""
    root = scratch(spark)
    rl.cloudfront_lines(rl.request_log(spark, sf_dir)).select("value").write.text(root)
    p = parse_cloudfront(read_cloudfront(spark, root))
    return p.groupBy("error").agg(F.count("*").alias("lines"), F.min("request_id").alias("first_request"), F.max(iso_millis(F.col("observed_at"))).alias("latest"))


@query(ORACLES["classify_user_agents"])
def rules_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes by rules that were read from a JSON document in the shared store."""
    root = scratch(spark)
    write_rules(spark, root)
    own = read_rules(spark, root)["user_agent"]
    c = with_class(rl.request_log(spark, sf_dir), classify_user_agent(F.col("user_agent"), own))
    return c.select("event_id", *(F.col(f"class.{k}").alias(k) for k in ("provider", "agent_type", "confidence", "matched_rule", "matched_by")))


@query(CLASSED + f"""SELECT strftime(stamp, '%Y-%m-%d') AS observed_date, 7 AS batch_id, count(*) AS rows FROM classed WHERE provider <> 'other' GROUP BY 1""")
def observation_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations read back by day after a batch was written twice, the first time with other rows."""
    root = scratch(spark)
    o = nginx_to_observations(rl.common_lines(rl.request_log(spark, sf_dir))).drop("ip_hash")
    write_observations(o.withColumn("observed_at", F.lit("1999-01-01T00:00:00.000Z")).limit(5), root, 7)
    write_observations(o, root, 7)
    return spark.read.parquet(root).groupBy(F.col("observed_date").cast("string").alias("observed_date"), "batch_id").agg(F.count("*").alias("rows"))


@query(LOG + f" SELECT error, count(*) AS lines FROM (SELECT {FAULT} AS error FROM log) WHERE error IS NOT NULL GROUP BY 1")
def dead_letter_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters read back by error after a batch was written twice."""
    root = scratch(spark)
    dead = split_errors(parse_nginx(rl.mixed_lines(rl.request_log(spark, sf_dir))))[1]
    for _ in range(2):
        write_dead_letters(dead, root, 0)
    return spark.read.parquet(root).groupBy("error").agg(F.count("*").alias("lines"))


@query(CLASSED + """SELECT provider, count(*) AS seen, count(*) FILTER (WHERE agent_type = 'ai_training_crawler') AS training FROM classed WHERE provider <> 'other' GROUP BY 1""")
def side_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations handed to two outputs, computed once."""
    root = scratch(spark)
    o = with_request_class(rl.request_log(spark, sf_dir)).where("class.provider <> 'other'").select(F.col("class.provider").alias("provider"), F.col("class.agent_type").alias("agent_type"))
    side_output(o, lambda df: df.select("provider").write.parquet(f"{root}/all"), lambda df: df.where("agent_type = 'ai_training_crawler'").write.parquet(f"{root}/training"))
    count = lambda name, to: spark.read.parquet(f"{root}/{name}").groupBy("provider").agg(F.count("*").alias(to))
    return count("all", "seen").join(count("training", "training"), "provider", "left").select("provider", "seen", F.coalesce("training", F.lit(0)).alias("training"))


FLAGS = ["1", "true", "yes", "on", "TRUE", " on", "0", ""]


@query(LOG + f" SELECT flag, count(*) AS n FROM (SELECT {pick(FLAGS)} AS flag FROM log) WHERE flag IN ('1', 'true', 'yes', 'on') GROUP BY 1")
def tracked_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of deployments whose setting switches the collection on."""
    log = rl.request_log(spark, sf_dir).withColumn("enabled", F.element_at(F.array(*map(F.lit, FLAGS)), (F.col("event_id") % len(FLAGS) + 1).cast("int")))
    return tracked(log).groupBy(F.col("enabled").alias("flag")).agg(F.count("*").alias("n"))


@query(ORACLES["client_ip_hmac"])
def client_ip_hmac_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashes again, with a table of keys that is too large to broadcast and one site that all rows have."""
    from .operators import privacy

    keys, most = test_keys(spark), privacy.BROADCAST_ROWS
    policy = Policy(query="omit", ip="hash", truncated_bits=128)
    privacy.BROADCAST_ROWS = 0
    try:
        o = observe_requests(rl.request_records(rl.request_log(spark, sf_dir)), "node", policy, keys, F.lit("main"), carry=("event_id",))
    finally:
        privacy.BROADCAST_ROWS = most
    return o.select("event_id", F.col("ip_hash.value").alias("value"))


# --- Streams ---------------------------------------------------------------------------------------------------------------------


@query(f"SELECT parsed, malformed, blank, skipped, queued FROM ({ORACLES['nginx_pass_stats']})")
def stream_pass_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a pass, summed over the micro-batches of a stream."""
    root = scratch(spark)
    rl.mixed_lines(rl.request_log(spark, sf_dir)).select("value").write.text(f"{root}/in")
    stream_nginx(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", stats=f"{root}/stats").awaitTermination()
    return spark.read.json(f"{root}/stats").agg(*(F.sum(c).alias(c) for c in ("parsed", "malformed", "blank", "skipped", "queued")))


@query(CF_CLASSED + f" SELECT provider, count(*) AS visits, min(request_id) AS first_request FROM (SELECT {CF_ROWS}) GROUP BY 1")
def stream_cloudfront_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of CDN lines has written; the stream starts again from a lost checkpoint, and replaces what it wrote."""
    root = scratch(spark)
    rl.cloudfront_lines(rl.request_log(spark, sf_dir)).select("value").write.text(f"{root}/in")
    for n in range(2):
        stream_cloudfront(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint-{n}").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy(F.col("class.provider").alias("provider")).agg(F.count("*").alias("visits"), F.min("request_id").alias("first_request"))


@query(CLASSED + f""", latest AS (SELECT date_trunc('hour', max(stamp)) AS hour FROM classed)
SELECT strftime(date_trunc('hour', stamp), '%Y-%m-%dT%H:%M:%S') AS start, count(*) AS visits FROM classed, latest WHERE date_trunc('hour', stamp) < latest.hour GROUP BY 1""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits by hour of a stream with a watermark: of all lines but the latest hour's, which is still open."""
    root = scratch(spark)
    log = rl.request_log(spark, sf_dir)
    last = log.agg(F.max("stamp").alias("at"))
    end = last.crossJoin(log.limit(1)).withColumn("stamp", F.date_trunc("hour", "at") + F.expr("INTERVAL 11 MINUTES")).drop("at")  # two single rows
    for part in (log, end):  # a line past the lateness of the open hour's begin closes the hours before
        rl.common_lines(part).select("value").write.mode("append").text(f"{root}/in")
        stream_rollup(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("start").agg(F.sum("visits").alias("visits")).select(F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss").alias("start"), "visits")


@query(CF_CLASSED + f""", sent AS (SELECT (event_id // 5) % 3 AS shard, count(*) AS events FROM (SELECT {CF_ROWS}) GROUP BY 1)
SELECT shard, ceil(events / 40.0)::BIGINT AS bodies, events::BIGINT AS events, events::BIGINT AS parsed FROM sent""")
def stream_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of envelopes into signed bodies; the first delivery fails, and the next start replays its micro-batch."""
    root = scratch(spark)
    e = rl.envelopes(rl.cloudfront_lines(rl.request_log(spark, sf_dir)))
    e.select((F.col("sequence_number") % 3).cast("string").alias("shard"), F.format_string("%020d", "sequence_number").alias("sequence_number"), "data").write.json(f"{root}/in")
    tries: list[int] = []

    def post(bodies: DataFrame, batch_id: int) -> None:
        tries.append(batch_id)
        if len(tries) == 1:
            raise ConnectionError("the endpoint is away")

    def start():
        return stream_envelopes(spark, f"{root}/in", f"{root}/outbox", f"{root}/checkpoint", test_keys(spark), "main", lambda n: f"batch-{n}", post, 40)

    try:
        start().awaitTermination()
    except Exception:  # the stream's own error class is not public
        if tries != [0]:
            raise
    start().awaitTermination()
    sent = spark.read.json(f"{root}/outbox")
    parsed = F.size(F.from_json("body", "struct<events: array<string>>")["events"])
    return sent.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count("*").alias("bodies"), F.sum("events").cast("long").alias("events"), F.sum(parsed).cast("long").alias("parsed"))


# --- Delivery rounds ---------------------------------------------------------------------------------------------------------------

ROUND_STATUS = f"({listed(CODES)})[(batch_id * 7 + attempt * 5) % {len(CODES)} + 1]"


@query(LOG + f""", batches AS (SELECT DISTINCT event_id // 10 AS batch_id FROM log), tries AS (
  SELECT batch_id, attempt, nullif({ROUND_STATUS}, 0) AS status FROM batches, (SELECT unnest([1, 2, 3]) AS attempt)
), judged AS (SELECT *, coalesce(status BETWEEN 200 AND 299, false) AS ok, status IS NULL OR status IN (408, 409, 425, 429) OR status >= 500 AS retryable FROM tries)
SELECT j.batch_id, j.attempt::INTEGER AS attempt, CASE j.attempt WHEN 1 THEN 0 WHEN 2 THEN 100 ELSE 200 END::BIGINT AS delay_ms, coalesce(j.status, -1)::INTEGER AS status, j.ok
FROM judged j WHERE NOT EXISTS (SELECT 1 FROM judged e WHERE e.batch_id = j.batch_id AND e.attempt < j.attempt AND NOT e.retryable)""")
def delivery_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All attempts of rounds in which whatever is due is posted, until every batch has a final outcome."""
    outbox = rl.request_log(spark, sf_dir).select(F.floor(F.col("event_id") / 10).alias("batch_id")).distinct()
    answer = F.nullif(F.element_at(F.array(*map(F.lit, CODES)), ((F.col("batch_id") * 7 + F.col("attempt") * 5) % len(CODES) + 1).cast("int")), F.lit(0))
    ledger = delivery.delivered(outbox, lambda due: due.withColumn("status", answer))
    return ledger.select("batch_id", "attempt", "delay_ms", F.coalesce("status", F.lit(-1)).alias("status"), "ok")


@query(LOG + " SELECT 'one' AS shard, event_id, ((row_number() OVER (ORDER BY event_id) - 1) // 100)::INT AS batch_no, ((row_number() OVER (ORDER BY event_id) - 1) % 100)::INT AS position FROM log")
def batch_assign_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a single source that has all rows."""
    log = rl.request_log(spark, sf_dir).select(F.lit("one").alias("shard"), "event_id")
    return delivery.assign_batches(log, "shard", ["event_id"], 100).select("shard", "event_id", "batch_no", "position")


# --- Parity of rules ---------------------------------------------------------------------------------------------------------------

# The exported rules, written down apart from the registry: id, provider, agent type, confidence, number of patterns.
EXPORTED = """
ua:openai:oai-searchbot openai_search_bot ai_search_crawler 0.99 1
ua:openai:gptbot openai_gptbot ai_training_crawler 0.98 1
ua:openai:chatgpt-user openai_chatgpt_user ai_browser_user 0.96 1
ua:anthropic:claude-searchbot anthropic_claude_search_bot ai_search_crawler 0.96 1
ua:anthropic:claude-user anthropic_claude_user ai_browser_user 0.94 1
ua:anthropic:claudebot anthropic_claudebot ai_training_crawler 0.96 1
ua:perplexity:perplexitybot perplexitybot ai_search_crawler 0.95 1
ua:perplexity:perplexity-user perplexity_user ai_browser_user 0.92 1
ua:google:google-agent google_agent ai_browser_user 0.91 1
ua:google:notebooklm google_notebooklm ai_browser_user 0.9 1
ua:google:googleother google_crawler search_crawler 0.9 1
ua:google:googlebot google_crawler search_crawler 0.9 1
ua:meta:externalagent meta_external_agent ai_training_crawler 0.91 1
ua:meta:externalfetcher meta_external_fetcher link_preview 0.86 3
ua:bytedance:bytespider bytedance_bytespider ai_training_crawler 0.9 1
ref:openai:chatgpt openai_chatgpt_referral ai_referral_visit 0.78 1
ref:openai ai_browser_referral ai_referral_visit 0.7 1
ref:anthropic:claude anthropic_claude_referral ai_referral_visit 0.72 1
ref:perplexity perplexity_referral ai_referral_visit 0.74 1
ref:google:gemini google_gemini_referral ai_referral_visit 0.7 3
ref:microsoft:copilot microsoft_copilot_referral ai_referral_visit 0.7 2
ref:google:search google_referral search_referral 0.82 1
ref:meta:ai meta_ai_referral ai_referral_visit 0.68 1
ref:xai:grok xai_grok_referral ai_referral_visit 0.68 1
ref:mistral:le-chat mistral_le_chat_referral ai_referral_visit 0.68 1
ref:generic-ai ai_browser_referral ai_referral_visit 0.55 1
query:openai:chatgpt openai_chatgpt_referral ai_referral_visit 0.68 1
"""

# Which rule each user agent and referer of the log must fall under, by its place in the log's lists.
AGENT_FIXTURES = {
    1: "ua:openai:oai-searchbot", 2: "ua:openai:gptbot", 3: "ua:openai:chatgpt-user", 4: "ua:anthropic:claude-searchbot", 5: "ua:anthropic:claude-user", 6: "ua:anthropic:claudebot", 7: "ua:perplexity:perplexitybot",
    8: "ua:perplexity:perplexity-user", 9: "ua:google:google-agent", 10: "ua:google:notebooklm", 11: "ua:google:googleother", 12: "ua:google:googlebot", 13: "ua:meta:externalagent", 14: "ua:meta:externalfetcher",
    15: "ua:bytedance:bytespider", 18: "ua:openai:gptbot",
}
REFERER_FIXTURES = {
    1: "ref:openai:chatgpt", 2: "ref:google:search", 3: "ref:anthropic:claude", 4: "ref:perplexity", 5: "ref:google:gemini", 6: "ref:microsoft:copilot", 8: "ref:meta:ai", 9: "ref:xai:grok", 10: "ref:mistral:le-chat",
    11: "ref:generic-ai", 12: "ref:openai", 14: "ref:openai:chatgpt", 15: "ref:microsoft:copilot", 18: "ref:google:search",
}


def exported_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, p, a, float(c), int(n)) for i, p, a, c, n in map(str.split, EXPORTED.strip().splitlines())], "id string, provider string, agent_type string, confidence double, patterns long")


def rule_parity_of(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(id, status) of two rule tables: both, or which of them has a rule that the other lacks or has in another form."""
    tagged = lambda df, name: df.select("id", F.lit(name).alias("status"))
    return tagged(ours.intersectAll(theirs), "both").unionByName(tagged(ours.exceptAll(theirs), "ours")).unionByName(tagged(theirs.exceptAll(ours), "theirs"))


@query(LOG + f""", exported AS (SELECT split_part(line, ' ', 1) AS id FROM (SELECT unnest({listed(EXPORTED.strip().splitlines())}) AS line)),
agents AS (SELECT {pick([AGENT_FIXTURES.get(i, '') for i in range(len(rl.USER_AGENTS))])} AS id FROM log), referers AS (SELECT {pick([REFERER_FIXTURES.get(i, '') for i in range(len(rl.REFERERS))], 5)} AS id FROM log)
SELECT e.id, 'both' AS status, count(f.id) AS fixtures, 0::BIGINT AS missed FROM exported e LEFT JOIN (FROM agents UNION ALL FROM referers) f ON e.id = f.id GROUP BY 1""")
def rule_export_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry against a separately written export, as sets, and how many requests of the log miss the rule that they must fall under."""
    table = rules_table(spark)
    ours = table.groupBy("id", "provider", "agent_type", "confidence").agg(F.count("*").alias("patterns"))
    log = rl.request_log(spark, sf_dir)

    def wanted(kind: str, fixtures: dict[int, str], count: int, step: int) -> DataFrame:
        place = (F.floor(F.col("event_id") / step) % count).cast("int")
        expected = F.element_at(F.array(*(F.lit(fixtures.get(i)).cast("string") for i in range(count))), place + 1)
        return log.select("event_id", F.lit(kind).alias("kind"), expected.alias("id")).where(F.col("id").isNotNull())

    def found(kind: str, c: Column) -> DataFrame:
        return with_class(log, c).select("event_id", F.lit(kind).alias("kind"), F.col("class.matched_rule").alias("id"))

    fixtures = wanted("ua", AGENT_FIXTURES, len(rl.USER_AGENTS), 1).unionByName(wanted("ref", REFERER_FIXTURES, len(rl.REFERERS), 5))
    classed = found("ua", classify_user_agent(F.col("user_agent"))).unionByName(found("ref", classify_referer(F.col("referer"))))
    missed = fixtures.join(classed, ["event_id", "kind", "id"], "left_anti").groupBy("id").agg(F.count("*").alias("missed"))
    seen = fixtures.groupBy("id").agg(F.count("*").alias("fixtures")).join(missed, "id", "left")
    parity = rule_parity_of(ours, exported_rules(spark)).join(seen, "id", "left")
    return parity.select("id", "status", F.coalesce("fixtures", F.lit(0)).alias("fixtures"), F.coalesce("missed", F.lit(0)).alias("missed"))
