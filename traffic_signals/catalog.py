"""All queries on request logs, by name, each with the SQL that an oracle runs on the same tables.

The SQL is written from the meaning of an operator, on the columns of the derived log rather than on the rendered lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import requestlog as rl
from .functions.exprs import http_method, iso_millis
from .functions.rules import QUERY_RULES, REFERER_RULES, USER_AGENT_RULES, Rule, rules_table
from .functions.schema import AGENT_TYPES, BUCKET_LABELS, CLASSIFIED_PROVIDERS, FAMILY_LABELS, HTTP_METHODS, INTEGRATION_KINDS, INTEGRATION_ORIGINS, PROVIDER_BUCKETS, SIGNAL_FAMILIES, SOURCE_PROVIDERS
from .operators import delivery, rollups
from .operators.classify import classify_landing_query, classify_referer, classify_user_agent, integration_origins, known_attribution, with_class, with_loose_request_class, with_request_class
from .operators.privacy import Policy, allow_headers, allow_pairs, apply_privacy, hmac_sha256, key_table, omit_query, resolve_policies, sanitize_referral_search, sha256_ip, strip_referer, truncated
from .operators.validate import judged_events, rejection, validate_events, validate_probe_responses, validate_probes
from .plans import jobs
from .plans.jobs import cloudfront_to_observations, envelopes_to_observations, forwardable, nginx_to_observations, observe_requests, union_observations
from .sources.cloudfront import decode_envelopes, parse_cloudfront
from .sources.nginx import origin_form, parse_nginx, target_path, target_search
from .sources.requests import page_route, read_requests, split_probes
from .tables import scratch

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- SQL fragments -------------------------------------------------------------------------------------------------------------


def text(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def listed(values: list) -> str:
    return "[" + ", ".join(text(v) if isinstance(v, str) else str(v) for v in values) + "]"


def pick(values: list, step: int = 1) -> str:
    return f"({listed(values)})[(event_id // {step}) % {len(values)} + 1]"


LOG = rf"""
WITH page_count AS (SELECT count(*) AS n FROM pages), raw_log AS (
  SELECT event_id, date_trunc('second', ts) AS stamp, url, list_filter([regexp_extract(url, '\?([^#]*)', 1), {pick(rl.QUERIES, 3)}], lambda x: x <> '') AS searches
  FROM events JOIN pages ON page_id = event_id % (SELECT n FROM page_count)
), log AS MATERIALIZED (
  SELECT event_id, stamp, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    CASE WHEN len(searches) > 0 THEN '?' || array_to_string(searches, '&') END AS search, {pick(rl.METHODS, 2)} AS method, {pick(rl.STATUSES)} AS status, event_id * 37 % 50000 AS bytes,
    '10.' || (event_id % 251) || '.' || (event_id % 13) || '.' || (event_id % 7) AS ip, nullif({pick(rl.USER_AGENTS)}, '-') AS user_agent, nullif({pick(rl.REFERERS, 5)}, '-') AS referer
  FROM raw_log
)"""

METHOD = f"CASE WHEN upper(method) IN ({listed(HTTP_METHODS[:-1])[1:-1]}) THEN upper(method) ELSE 'OTHER' END"
ISO = "strftime(stamp, '%Y-%m-%dT%H:%M:%S') || '.000Z'"


def rule_of(column: str, rules: list[Rule], fallback: str) -> str:
    arms = " ".join(f"WHEN {' OR '.join(f'regexp_matches({column}, {text(p)}, {text('i')})' for p in r.patterns)} THEN {text(r.id)}" for r in rules)
    return f"CASE WHEN {column} IS NULL THEN {text(fallback)} {arms} ELSE {text(fallback)} END"


def of_rule(rule: str, field: str, default: str, rules: list[Rule]) -> str:
    value = lambda r: str(getattr(r, field)) + "::DOUBLE" if field == "confidence" else text(getattr(r, field))
    return f"CASE {rule} " + " ".join(f"WHEN {text(r.id)} THEN {value(r)}" for r in rules) + f" ELSE {default} END"


def decoded(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '%([^0-9A-Fa-f]|$|[0-9A-Fa-f]([^0-9A-Fa-f]|$))') THEN {x} ELSE coalesce(try(url_decode(replace({x}, '+', ' '))), {x}) END"


PAIRS = "list_filter(str_split(ltrim(search, '?'), '&'), lambda p: p <> '')"
KEY, VALUE = "split_part(p, '=', 1)", "CASE WHEN instr(p, '=') > 0 THEN substr(p, instr(p, '=') + 1) ELSE '' END"
SITE_OF = r"regexp_replace(regexp_extract(regexp_replace(regexp_replace(lower(trim(v)), '^[a-z][a-z0-9+.-]*://', ''), '^www\.', ''), '^[^/?#]*'), '[^a-z0-9]+', '', 'g')"
OWN = f"list_filter({PAIRS}, lambda p: lower({decoded(KEY)}) IN ('utm_source', 'source'))"
SITES = f"list_transform(list_transform({OWN}, lambda p: {decoded('(' + VALUE + ')')}), lambda v: {SITE_OF})"
SITE = f"list_filter({SITES}, lambda s: s IN ('chatgpt', 'chatgptcom', 'chatopenaicom'))[1]"
ALL_RULES = [*USER_AGENT_RULES, *REFERER_RULES, *QUERY_RULES]

CLASSED = LOG + f""", ruled AS MATERIALIZED (
  SELECT *, {rule_of("user_agent", USER_AGENT_RULES, "none")} AS r1, {rule_of("referer", REFERER_RULES, "none")} AS r2,
    CASE WHEN {SITE} IS NOT NULL THEN 'query:openai:chatgpt' ELSE 'none' END AS r3, {SITE} AS site FROM log
), ranked AS MATERIALIZED (
  SELECT *, {of_rule("r1", "confidence", "0::DOUBLE", ALL_RULES)} AS c1, {of_rule("r2", "confidence", "0::DOUBLE", ALL_RULES)} AS c2, {of_rule("r3", "confidence", "0::DOUBLE", ALL_RULES)} AS c3 FROM ruled
), chosen AS MATERIALIZED (
  SELECT *, CASE WHEN c1 = 0 AND c2 = 0 AND c3 = 0 THEN 'fallback:unknown-request' WHEN c1 >= c2 AND c1 >= c3 THEN r1 WHEN c2 >= c3 THEN r2 ELSE r3 END AS rule FROM ranked
), classed AS MATERIALIZED (
  SELECT *, {of_rule("rule", "provider", "'other'", ALL_RULES)} AS provider, {of_rule("rule", "agent_type", "'other'", ALL_RULES)} AS agent_type, {of_rule("rule", "confidence", "0::DOUBLE", ALL_RULES)} AS confidence,
    CASE WHEN rule LIKE 'ua:%' THEN 'user_agent' WHEN rule LIKE 'ref:%' THEN 'referer' WHEN rule LIKE 'query:%' THEN 'query' ELSE 'other' END AS matched_by FROM chosen
)"""  # noqa: E501


def grouped(column: str, groups: dict[str, list[str]]) -> str:
    return "CASE " + " ".join(f"WHEN {column} IN ({listed(v)[1:-1]}) THEN {text(k)}" for k, v in groups.items()) + " ELSE 'other' END"


BUCKET, FAMILY = grouped("provider", PROVIDER_BUCKETS), grouped("agent_type", SIGNAL_FAMILIES)
STRIPPED = "nullif(regexp_extract(trim(referer), '^[^?#]*'), '')"
SAFE = "CASE WHEN agent_type = 'ai_referral_visit' AND matched_by = 'query' AND provider = 'openai_chatgpt_referral' THEN CASE WHEN site = 'chatopenaicom' THEN '?utm_source=chat.openai.com' WHEN site IS NOT NULL THEN '?utm_source=chatgpt.com' END END"


def cleaned(search: str) -> str:
    return f"CASE WHEN agent_type <> 'ai_referral_visit' THEN {search} ELSE ({SAFE}) END"


def allowed(keys: list[str], key: str) -> str:
    kept = f"list_filter({PAIRS}, lambda p: {key} IN ({listed(keys)[1:-1]}))"
    return f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') END"


# --- Helpers -------------------------------------------------------------------------------------------------------------------


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = rl.request_log(spark, sf_dir)
    return with_request_class(log)


def flat(c: str = "class") -> list[Column]:
    return [F.col(f"{c}.{k}").alias(k) for k in ("provider", "agent_type", "confidence", "matched_rule", "matched_by")]


def observed(df: DataFrame) -> DataFrame:
    """Flat columns of observations."""
    return df.select("event_id", "observed_at", "host", "path", "search", "method", "user_agent", "referer", "country", "region", "request_id", F.col("class.provider").alias("provider"), F.col("ip_hash.algorithm").alias("ip_algorithm"))


# --- Parsing -------------------------------------------------------------------------------------------------------------------

ENTRY = ["event_id", "remote_address", "host", "method", "path", "search", "protocol", "status", "bytes_sent", "referer", "user_agent"]
PARSED = f"SELECT event_id, ip AS remote_address, {{host}} AS host, {METHOD} AS method, path, search, {{protocol}} AS protocol, status, bytes AS bytes_sent, referer, user_agent, {ISO} AS observed FROM log"


@query(LOG + PARSED.format(host="'site.example'", protocol="'HTTP/1.1'"))
def nginx_common_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_nginx(rl.common_lines(rl.request_log(spark, sf_dir)), "common", "site.example").select(*ENTRY, iso_millis(F.col("observed_at")).alias("observed"))


@query(LOG + f"""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ip END AS remote_address, host, {METHOD} AS method, path, search, CASE WHEN event_id % 2 = 0 THEN 'HTTP/2.0' END AS protocol, status,
  CASE WHEN event_id % 2 = 0 THEN bytes END AS bytes_sent, CASE WHEN event_id % 2 = 1 THEN referer END AS referer, user_agent, {ISO} AS observed FROM log""")
def nginx_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_nginx(rl.json_lines(rl.request_log(spark, sf_dir)), "json").select(*ENTRY, iso_millis(F.col("observed_at")).alias("observed"))


FAULT = """CASE event_id % 11 WHEN 1 THEN 'malformed_line' WHEN 2 THEN 'empty_line' WHEN 3 THEN 'malformed_json' WHEN 4 THEN 'malformed_json' WHEN 5 THEN 'malformed_request'
  WHEN 6 THEN 'missing_timestamp' WHEN 7 THEN 'missing_timestamp' END"""


@query(LOG + f"SELECT event_id, {FAULT} AS error FROM log WHERE {FAULT} IS NOT NULL")
def nginx_auto_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_nginx(rl.mixed_lines(rl.request_log(spark, sf_dir))).where(F.col("error").isNotNull()).select("event_id", "error")


@query(CLASSED + f""", seen AS (
  SELECT c.event_id, {FAULT} AS error,
    CASE WHEN r1 <> 'none' THEN true WHEN event_id % 2 = 0 THEN true ELSE r2 <> 'none' END OR r3 <> 'none' AS known FROM classed c
)
SELECT count(*) FILTER (WHERE error IS NULL) AS parsed, count(*) FILTER (WHERE error <> 'empty_line') AS malformed, count(*) FILTER (WHERE error = 'empty_line') AS blank,
  count(*) FILTER (WHERE error IS NULL AND NOT known) AS skipped, count(*) FILTER (WHERE error IS NULL AND known) AS queued,
  ceil(count(*) FILTER (WHERE error IS NULL AND known) / 25.0)::BIGINT AS batches
FROM (SELECT event_id, error, CASE WHEN event_id % 2 = 0 THEN r1 <> 'none' OR r3 <> 'none' ELSE known END AS known FROM (SELECT s.*, c.r1, c.r3 FROM seen s JOIN classed c USING (event_id)))""")
def nginx_pass_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_nginx(rl.mixed_lines(rl.request_log(spark, sf_dir)))
    return rollups.pass_statistics(with_request_class(parsed), batch_size=25)


CF = LOG + f""", cf AS (
  SELECT event_id, CASE WHEN event_id % 10 = 9 THEN 'wrong_field_count' WHEN event_id % 10 = 7 THEN 'missing_host' END AS error, strftime(stamp, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 10 < 5 THEN '.000Z' ELSE '.125Z' END AS observed_at,
    host, path, CASE WHEN event_id % 10 = 3 AND search IS NULL THEN '?again=1' ELSE search END AS search, {METHOD} AS method, user_agent, referer, 'req-' || event_id AS request_id,
    CASE event_id % 4 WHEN 0 THEN 'US' WHEN 2 THEN 'FR' END AS country FROM log
)"""


@query(CF + """ SELECT event_id, error, CASE WHEN error IS NULL THEN observed_at END AS observed, CASE WHEN error IS NULL THEN host END AS host, CASE WHEN error IS NULL THEN path END AS path,
  CASE WHEN error IS NULL THEN search END AS search, CASE WHEN error IS NULL THEN method END AS method, CASE WHEN error IS NULL THEN request_id END AS request_id, CASE WHEN error IS NULL THEN country END AS country FROM cf""")
def cloudfront_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_cloudfront(rl.cloudfront_lines(rl.request_log(spark, sf_dir)))
    return p.select("event_id", "error", iso_millis(F.col("observed_at")).alias("observed"), "host", "path", "search", "method", "request_id", "country")


@query(CF + " SELECT event_id // 5 AS sequence_number, request_id, path FROM cf WHERE error IS NULL")
def kinesis_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = decode_envelopes(rl.envelopes(rl.cloudfront_lines(rl.request_log(spark, sf_dir))))
    return parse_cloudfront(lines).where(F.col("error").isNull()).select("sequence_number", "request_id", "path")


@query(LOG + " SELECT event_id, CASE WHEN event_id % 3 = 1 THEN '/' ELSE path END AS path, search FROM log")
def request_target_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = rl.request_log(spark, sf_dir)
    k = F.col("event_id") % 3
    full = F.concat(F.when(k == 0, "").otherwise(F.concat(F.lit("HTTPS://"), "host")), F.when(k == 1, "").otherwise(F.col("path")), F.coalesce("search", F.lit("")))
    return log.select("event_id", origin_form(full).alias("rest")).select("event_id", target_path(F.col("rest")).alias("path"), target_search(F.col("rest")).alias("search"))


@query(LOG + f" SELECT {METHOD} AS method, count(*) AS n FROM log GROUP BY 1")
def http_method_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.request_log(spark, sf_dir).groupBy(http_method(F.col("method")).alias("method")).agg(F.count("*").alias("n"))


# --- Classification ------------------------------------------------------------------------------------------------------------


def _single(rule: str, fallback: str) -> str:
    r = f"CASE WHEN {rule} = 'none' THEN {text(fallback)} ELSE {rule} END"
    matched = f"CASE WHEN {rule} = 'none' THEN 'other' WHEN {rule} LIKE 'ua:%' THEN 'user_agent' WHEN {rule} LIKE 'ref:%' THEN 'referer' ELSE 'query' END"
    return CLASSED + f""" SELECT event_id, {of_rule(rule, "provider", "'other'", ALL_RULES)} AS provider, {of_rule(rule, "agent_type", "'other'", ALL_RULES)} AS agent_type,
      {of_rule(rule, "confidence", "0::DOUBLE", ALL_RULES)} AS confidence, {r} AS matched_rule, {matched} AS matched_by FROM classed"""


@query(_single("r1", "fallback:unknown-user-agent"))
def classify_user_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_class(rl.request_log(spark, sf_dir), classify_user_agent(F.col("user_agent"))).select("event_id", *flat())


@query(_single("r2", "fallback:unknown-referer"))
def classify_referers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_class(rl.request_log(spark, sf_dir), classify_referer(F.col("referer"))).select("event_id", *flat())


@query(_single("r3", "fallback:unknown-query"))
def classify_landing_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_class(rl.request_log(spark, sf_dir), classify_landing_query(known_attribution(F.col("search")))).select("event_id", *flat())


@query(CLASSED + " SELECT event_id, provider, agent_type, confidence, rule AS matched_rule, matched_by FROM classed")
def classify_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classed(spark, sf_dir).select("event_id", *flat())


@query(CLASSED + f" SELECT {BUCKET} AS bucket, {FAMILY} AS family, count(*) AS visits FROM classed WHERE provider <> 'other' GROUP BY 1, 2")
def provider_bucket_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rl.common_lines(rl.request_log(spark, sf_dir))
    return rollups.by_bucket(nginx_to_observations(lines))


@query(CLASSED + f" SELECT strftime(stamp, '%Y-%m-%d') AS day, {BUCKET} AS bucket, {FAMILY} AS family, count(*) AS visits FROM classed GROUP BY 1, 2, 3")
def signal_family_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_bucket(classed(spark, sf_dir).withColumn("day", F.date_format("stamp", "yyyy-MM-dd")), "day")


KINDS = [*INTEGRATION_KINDS, "unheard_of"]
ORIGIN = lambda i: "CASE kind " + " ".join(f"WHEN {text(o[0])} THEN {text(o[i])}" for o in INTEGRATION_ORIGINS) + f" ELSE {text(INTEGRATION_ORIGINS[-1][i])} END"


@query(LOG + f" SELECT kind, {ORIGIN(1)} AS origin_provider, {ORIGIN(2)} AS origin_label, count(*) AS n FROM (SELECT {pick(KINDS)} AS kind FROM log) GROUP BY 1, 2, 3")
def integration_origin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = rl.request_log(spark, sf_dir).select(F.element_at(F.array(*map(F.lit, KINDS)), (F.col("event_id") % len(KINDS) + 1).cast("int")).alias("kind"))
    return integration_origins(kinds.groupBy("kind").agg(F.count("*").alias("n"))).select("kind", "origin_provider", "origin_label", "n")


@query(CLASSED + " SELECT event_id, provider FROM classed WHERE provider <> 'other'")
def forward_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forwardable(classed(spark, sf_dir)).select("event_id", F.col("class.provider").alias("provider"))


ROUTES = ["/api/x", "/apis", "/_next/static/a.js", "/favicon.ico", "/robots.txt", "/img/a.png", "/a.png/b", "/docs.xml", "/feed.json"]


@query(LOG + rf""" SELECT event_id, p AS path FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN {pick(ROUTES)} ELSE path END AS p FROM log)
  WHERE NOT regexp_matches(p, '^/(api|_next/static|_next/image|favicon.ico|robots.txt|sitemap.xml)') AND NOT regexp_matches(p, '\.(png|jpg|jpeg|gif|svg|ico|webp|css|js|map|txt|xml)$')""")
def route_matcher(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("event_id") % 2 == 0, F.element_at(F.array(*map(F.lit, ROUTES)), (F.col("event_id") % len(ROUTES) + 1).cast("int"))).otherwise(F.col("path"))
    return rl.request_log(spark, sf_dir).select("event_id", path.alias("path")).where(page_route(F.col("path")))


@query(LOG + " SELECT event_id, 'p' || event_id AS probe_id, 't' AS probe_token FROM log WHERE event_id % 17 = 5 AND event_id % 2 = 0 AND event_id % 3 <> 0")
def setup_probe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes, _ = split_probes(rl.request_records(rl.request_log(spark, sf_dir)))
    return probes.select("event_id", "probe_id", "probe_token")


# --- Privacy -------------------------------------------------------------------------------------------------------------------


@query(CLASSED + f" SELECT event_id, '/_hidden' AS path, {cleaned('search')} AS search, {STRIPPED} AS referer FROM classed")
def path_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_privacy(classed(spark, sf_dir), Policy(path="redact", path_replacement="/_hidden")).select("event_id", "path", "search", "referer")


@query(CLASSED + f" SELECT event_id, {SAFE} AS search FROM classed")
def query_omit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classed(spark, sf_dir).select("event_id", omit_query(F.col("search"), F.col("class")).alias("search"))


@query(LOG + f" SELECT event_id, {allowed(['utm_source', 'page', 'a'], decoded(KEY))} AS search FROM log")
def query_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.request_log(spark, sf_dir).select("event_id", allow_pairs(F.col("search"), F.array(F.lit("utm_source"), F.lit("page"), F.lit("a"))).alias("search"))


@query(LOG + f" SELECT event_id, {allowed(['utm_source', 'page', 'a'], KEY)} AS search FROM log")
def query_allowlist_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.request_log(spark, sf_dir).select("event_id", allow_pairs(F.col("search"), F.array(F.lit("utm_source"), F.lit("page"), F.lit("a")), decode=False).alias("search"))


@query(LOG + f" SELECT event_id, {STRIPPED} AS referer FROM log")
def referer_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.request_log(spark, sf_dir).select("event_id", strip_referer(F.col("referer")).alias("referer"))


@query(CLASSED + f" SELECT event_id, {cleaned('search')} AS search FROM classed")
def referral_search_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classed(spark, sf_dir).select("event_id", sanitize_referral_search(F.col("search"), F.col("class")).alias("search"))


SALT = "a salt for tests only"


def pad(byte: int) -> str:
    return "'" + "".join(f"\\x{b ^ byte:02X}" for b in SALT.encode().ljust(64, b"\0")) + "'::BLOB"


def hmac_sql(message: str) -> str:
    return f"sha256({pad(0x5C)} || unhex(sha256({pad(0x36)} || encode({message}))))"


def test_keys(spark: SparkSession) -> DataFrame:
    return key_table(spark.range(1).select(F.lit("main").alias("site"), F.lit("k1").alias("key_id"), F.lit(SALT).alias("salt")))


@query(LOG + f" SELECT event_id, substr({hmac_sql('ip')}, 1, 32) AS value FROM log")
def ip_hmac(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = rl.request_log(spark, sf_dir).withColumn("site", F.lit("main")).join(F.broadcast(test_keys(spark)), "site")
    return log.select("event_id", truncated(hmac_sha256(F.col("ip"), F.col("ipad"), F.col("opad")), F.lit(128)).alias("value"))


@query(LOG + f" SELECT event_id, sha256({text(SALT)} || ':' || ip) AS value FROM log")
def ip_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.request_log(spark, sf_dir).select("event_id", sha256_ip(F.col("ip"), F.lit(SALT)).alias("value"))


@query(LOG + f""" SELECT event_id, CASE WHEN event_id % 17 = 3 THEN NULL WHEN referer IS NOT NULL THEN {STRIPPED} END AS referer, 'r' || event_id AS request_id, (CASE WHEN referer IS NULL OR event_id % 17 = 3 THEN 0 ELSE 1 END + 1)::INT AS n FROM log""")
def header_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = allow_headers(F.col("headers"), ["Referer", "X-Request-Id"])
    r = rl.request_records(rl.request_log(spark, sf_dir)).select("event_id", kept.alias("h"))
    return r.select("event_id", F.try_element_at("h", F.lit("referer")).alias("referer"), F.try_element_at("h", F.lit("x-request-id")).alias("request_id"), F.size("h").alias("n"))


@query(CLASSED + f""", sited AS (SELECT *, event_id % 4 AS k FROM classed)
SELECT event_id, CASE WHEN k = 2 THEN '/_redacted' ELSE path END AS path, CASE k WHEN 0 THEN {cleaned('search')} WHEN 1 THEN CASE WHEN agent_type <> 'ai_referral_visit' THEN {allowed(['page'], decoded(KEY))} END ELSE {cleaned(SAFE)} END AS search FROM sited""")
def site_policy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classed(spark, sf_dir).withColumn("host", F.concat(F.lit("site"), F.col("event_id") % 4))
    p = spark.sql("""SELECT * FROM VALUES ('site0', 'keep', array('x'), NULL, NULL), ('site1', NULL, array('page'), NULL, NULL), ('site2', 'omit', NULL, 'redact', NULL)
      AS t(host, query_policy, allow, path_policy, path_replacement)""")
    return resolve_policies(rows, p).select("event_id", "path", "search")


# --- Validation ----------------------------------------------------------------------------------------------------------------

# Faults by event: what is wrong in the JSON, and the issues that must follow, in order.
NAMES = lambda xs: ", ".join(xs)
GOOD = {
    "schemaVersion": "1", "eventKind": '"request_observation"', "sourceProvider": '"manual"', "observedAt": '"2024-01-01T00:00:00Z"', "request": '{"host":"h","path":"/","method":"GET"}',
    "providerClassification": '{"provider":"other","agentType":"other","confidence":0,"matchedBy":["other"]}',
}
EVENT_CASES: list[tuple[dict, str]] = [
    ({}, ""),
    ({"schemaVersion": "2", "more": "1"}, ""),
    ({"schemaVersion": "1.0"}, ""),
    ({"schemaVersion": "0"}, "schemaVersion must be >= 1"),
    ({"schemaVersion": '"1"'}, "schemaVersion must be an integer"),
    ({"eventKind": '"x"'}, "eventKind must be request_observation"),
    ({"sourceProvider": "null"}, f"sourceProvider must be one of {NAMES(SOURCE_PROVIDERS)}"),
    ({"observedAt": '"2026-02-31T00:00:00Z"'}, "observedAt must be an ISO date-time timestamp"),
    ({"observedAt": '"2026-02-28"'}, "observedAt must be an ISO date-time timestamp"),
    ({"observedAt": "5"}, "observedAt must be an ISO timestamp"),
    ({"request": "[]"}, "request must be an object"),
    ({"request": '{"host":"","path":"x","search":"q","method":"get","userAgent":1,"zz":1}'}, "request.zz is not allowed; host must be a non-empty string; request.path must start with /; request.search must be empty or start with ?; " f"method must be one of {NAMES(HTTP_METHODS)}; userAgent must be a string when present"),
    ({"request": '{"host":"h","path":"/","search":"","method":"GET"}'}, ""),
    ({"providerClassification": '{"provider":"x","agentType":"y","confidence":2,"matchedBy":[]}'}, f"provider must be one of {NAMES(CLASSIFIED_PROVIDERS)}; agentType must be one of {NAMES(AGENT_TYPES)}; providerClassification.confidence must be between 0 and 1; providerClassification.matchedBy must be a non-empty array"),
    ({"providerClassification": '{"provider":"other","agentType":"other","confidence":"0","matchedBy":["other","q",1]}'}, "confidence must be a finite number; providerClassification.matchedBy[1] is invalid; providerClassification.matchedBy[2] is invalid"),
    ({"location": "null"}, "location must be an object"),
    ({"location": '{"country":"us","region":""}'}, "location.country must be an ISO 3166-1 alpha-2 code; region must be a non-empty string"),
    ({"ipHash": '{"algorithm":"md5","truncatedBits":0,"originalIpRetention":"kept"}'}, "algorithm must be one of hmac-sha256, sha256, none; ipHash.truncatedBits must be >= 1; ipHash.originalIpRetention is invalid"),
    ({"integration": '{"kind":"x","requestId":null}'}, f"kind must be one of {NAMES(INTEGRATION_KINDS)}; name must be a non-empty string; requestId must be a non-empty string"),
    (None, "event must be an object"),
]
PROBE_GOOD = {k: v for k, v in GOOD.items() if k != "providerClassification"} | {"eventKind": '"setup_probe"', "probe": '{"id":"a","token":"b"}'}
PROBE_CASES: list[tuple[dict, str]] = [
    ({}, ""),
    ({"more": "1"}, "event.more is not allowed"),
    ({"probe": '{"id":"","token":1,"x":2}'}, "probe.x is not allowed; id must be a non-empty string; token must be a non-empty string"),
    ({"probe": "null"}, "probe must be an object"),
    ({"integration": '{"name":"n","kind":"manual"}'}, ""),
    (None, "setup probe event must be an object"),
]
RESPONSE_GOOD = {"ok": "true", "eventKind": '"setup_probe"', "probeId": '"a"', "receivedAt": '"2024-01-01T00:00:00.5+01:00"'}
RESPONSE_CASES: list[tuple[dict, str]] = [
    ({}, ""),
    ({"ok": "1", "zz": "1"}, "response.zz is not allowed; ok must be a boolean"),
    ({"probeId": '""', "receivedAt": '"2024-01-01T24:00:00Z"'}, "probeId must be a non-empty string; receivedAt must be an ISO date-time timestamp"),
    (None, "setup probe response must be an object"),
]


def _records(spark: SparkSession, sf_dir: str, good: dict, cases: list[tuple[dict, str]]) -> DataFrame:
    made = ["[1] x" if c is None else "{" + ",".join(f'"{k}":{v}' for k, v in (good | c).items()) + "}" for c, _ in cases]
    return rl.request_log(spark, sf_dir).select("event_id", F.element_at(F.array(*map(F.lit, made)), (F.col("event_id") % len(made) + 1).cast("int")).alias("event"))


def _issues_sql(cases: list[tuple[dict, str]]) -> str:
    return LOG + f" SELECT event_id, {pick([m for _, m in cases])} AS reason FROM log"


def _reasons(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.array_join("issues", "; ").alias("reason"))


@query(_issues_sql(EVENT_CASES))
def validate_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(validate_events(_records(spark, sf_dir, GOOD, EVENT_CASES)))


@query(_issues_sql(PROBE_CASES))
def validate_probe_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(validate_probes(_records(spark, sf_dir, PROBE_GOOD, PROBE_CASES)))


@query(_issues_sql(RESPONSE_CASES))
def validate_probe_response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(validate_probe_responses(_records(spark, sf_dir, RESPONSE_GOOD, RESPONSE_CASES)))


# --- Profiles ------------------------------------------------------------------------------------------------------------------

PORT = "CASE WHEN event_id % 17 = 2 THEN ':8443' ELSE '' END"
PAGE = "CASE WHEN event_id % 17 = 5 THEN '/__setup-probe' ELSE path END"


IS_PROBE = "event_id % 17 = 5 AND event_id % 2 = 0 AND event_id % 3 <> 0"


def profile_sql(host: str, request_id: str, country: str, region: str, search: str, ip: str, second_referer: bool = True, untrimmed: bool = False, probes: bool = True) -> str:
    base = CLASSED if second_referer else CLASSED.replace(f"nullif({pick(rl.REFERERS, 5)}, '-') AS referer", f"CASE WHEN event_id % 17 = 3 THEN NULL ELSE nullif({pick(rl.REFERERS, 5)}, '-') END AS referer")
    agent = "CASE WHEN event_id % 17 = 1 THEN ' ' || user_agent ELSE user_agent END" if untrimmed else "user_agent"
    return base + f""" SELECT event_id, {ISO} AS observed_at, {host} AS host, {PAGE} AS path, {search} AS search, {METHOD} AS method, {agent} AS user_agent, {STRIPPED} AS referer, {country} AS country, {region} AS region,
      {request_id} AS request_id, provider, {ip} AS ip_algorithm FROM classed WHERE provider <> 'other' {f"AND NOT ({IS_PROBE})" if probes else ""}"""


GEO = "CASE event_id % 3 WHEN 0 THEN 'DE' WHEN 1 THEN {fr} ELSE {other} END"


def _profile(name: str):
    return lambda spark, sf_dir: observed(observe_requests(rl.request_records(rl.request_log(spark, sf_dir)), name, carry=("event_id",)))


for _name, _sql in {
    "vercel": profile_sql("host", "'r' || event_id", "'US'", "NULL", cleaned("search"), "'none'"),
    "node": profile_sql(f"host || {PORT}", "'r' || event_id", "NULL", "NULL", cleaned(SAFE), "'none'"),
    "cloudflare": profile_sql(f"host || {PORT}", "'ray' || event_id", GEO.format(fr="NULL", other="NULL"), "'BE'", cleaned(SAFE), "'none'", False, True),
    "netlify": profile_sql(f"host || {PORT}", "'id' || event_id", GEO.format(fr="'FR'", other="NULL"), "'BE'", cleaned(SAFE), "'none'", False, True),
    "fastly": profile_sql(f"host || {PORT}", "'id' || event_id", GEO.format(fr="'fr'", other="'x1'"), "'BE'", cleaned(SAFE), "NULL"),
    "wordpress": profile_sql(f"host || {PORT}", "NULL", "NULL", "NULL", "NULL", "'none'", False, probes=False),
}.items():
    QUERIES[f"observe_{_name}"], ORACLES[f"observe_{_name}"] = _profile(_name), _sql


CF_CLASSED = CLASSED.replace(
    "FROM raw_log\n)", "FROM raw_log WHERE event_id % 10 NOT IN (7, 9)\n)"
).replace("CASE WHEN len(searches) > 0 THEN '?' || array_to_string(searches, '&') END AS search", "CASE WHEN len(searches) > 0 THEN '?' || array_to_string(searches, '&') WHEN event_id % 10 = 3 THEN '?again=1' END AS search")
CF_ROWS = f"""event_id, strftime(stamp, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 10 < 5 THEN '.000Z' ELSE '.125Z' END AS observed_at, host, path, {cleaned(SAFE)} AS search, {METHOD} AS method, user_agent,
  {STRIPPED} AS referer, CASE event_id % 4 WHEN 0 THEN 'US' WHEN 2 THEN 'FR' END AS country, NULL AS region, 'req-' || event_id AS request_id, provider, 'none' AS ip_algorithm FROM classed WHERE provider <> 'other'"""


@query(CF_CLASSED + " SELECT " + CF_ROWS)
def observe_cloudfront(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed(cloudfront_to_observations(rl.cloudfront_lines(rl.request_log(spark, sf_dir)), carry=("event_id",)))


@query(CF_CLASSED + f" SELECT sequence_number, count(*) AS events, min(request_id) AS first_request FROM (SELECT event_id // 5 AS sequence_number, * FROM (SELECT {CF_ROWS})) GROUP BY 1")
def observe_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = envelopes_to_observations(rl.envelopes(rl.cloudfront_lines(rl.request_log(spark, sf_dir))), carry=("sequence_number",))
    return o.groupBy("sequence_number").agg(F.count("*").alias("events"), F.min("request_id").alias("first_request"))


# What a referral may keep is read from what the allow-list, on undecoded keys, has left.
SITE_LEFT = SITE.replace(OWN, f"list_filter({OWN}, lambda p: {KEY} IN ('page', 'utm_source'))")


@query(CLASSED + f""" SELECT event_id, {ISO} AS observed_at, 'unknown.local' AS host, path, {cleaned(allowed(['page', 'utm_source'], KEY)).replace("site", f"({SITE_LEFT})")} AS search, {METHOD} AS method, user_agent, {STRIPPED} AS referer, NULL AS country, NULL AS region,
  NULL AS request_id, provider, NULL AS ip_algorithm FROM classed WHERE provider <> 'other'""")
def observe_nginx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed(nginx_to_observations(rl.common_lines(rl.request_log(spark, sf_dir)), query="allowlist", allow=("page", "utm_source"), carry=("event_id",)))


@query(ORACLES["classify_requests"])
def classify_loose_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classes from requests that name their parts in other ways, by turns."""
    log = rl.request_log(spark, sf_dir)
    even = F.col("event_id") % 2 == 0
    header = lambda name, c: F.struct(F.lit(name).alias("key"), F.coalesce(c, F.lit("")).alias("value"))
    headers = F.map_from_entries(F.array(header("User-Agent", F.col("user_agent")), header("REFERRER", F.when(~even, F.col("referer")))))
    loose = log.select(
        "event_id", F.when(even, F.col("user_agent")).alias("user_agent"), F.lit(" ").alias("referer"), F.when(even, F.col("referer")).alias("referrer"), headers.alias("headers"),
        F.lit("").alias("query"), F.when(even, F.concat(F.lit("https://"), "host", "path", "search")).alias("url"), F.when(~even, F.col("search")).alias("landing_url"),
    )
    return with_loose_request_class(loose).select("event_id", *flat())


@query(ORACLES["observe_vercel"])
def observe_scanned_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of one runtime from collected records in files."""
    root = scratch(spark)
    rl.request_records(rl.request_log(spark, sf_dir)).drop("event_id").write.json(f"{root}/in")
    found = observe_requests(read_requests(spark, f"{root}/in"), "vercel")
    return observed(found.withColumn("event_id", F.substring("request_id", 2, 20).cast("long")))


@query(CLASSED + f" SELECT event_id, substr({hmac_sql('ip')}, 1, 32) AS value FROM classed WHERE provider <> 'other' AND NOT ({IS_PROBE})")
def client_ip_hmac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of the first forwarded address of each visit."""
    policy = Policy(query="omit", ip="hash", truncated_bits=128)
    o = observe_requests(rl.request_records(rl.request_log(spark, sf_dir)), "node", policy, test_keys(spark), F.lit("main"), carry=("event_id",))
    return o.select("event_id", F.col("ip_hash.value").alias("value"))


@query(CLASSED + f""" SELECT source_provider, count(*) AS events FROM (SELECT 'nginx_log_forwarder' AS source_provider FROM classed WHERE provider <> 'other'
  UNION ALL SELECT 'vercel' FROM classed WHERE provider <> 'other' AND NOT ({IS_PROBE})) GROUP BY 1""")
def observe_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = rl.request_log(spark, sf_dir)
    return union_observations(nginx_to_observations(rl.common_lines(log)), observe_requests(rl.request_records(log), "vercel")).groupBy("source_provider").agg(F.count("*").alias("events"))


@query(CLASSED + f""" SELECT bucket, family, CASE bucket {" ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in BUCKET_LABELS.items())} END AS bucket_label,
  CASE family {" ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in FAMILY_LABELS.items())} END AS family_label, visits
  FROM (SELECT {BUCKET} AS bucket, {FAMILY} AS family, count(*) AS visits FROM classed GROUP BY 1, 2)""")
def labelled_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_labels(rollups.by_bucket(classed(spark, sf_dir)))


@query(LOG + f" SELECT reason, count(*) AS events FROM (SELECT nullif({pick([m for _, m in EVENT_CASES])}, '') AS reason FROM log) GROUP BY 1")
def event_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records in files of JSON lines: accepted ones (no reason), and rejected ones by their reason."""
    root = scratch(spark)
    _records(spark, sf_dir, GOOD, EVENT_CASES).select("event").write.text(f"{root}/in")
    return judged_events(spark, f"{root}/in").groupBy(rejection().alias("reason")).agg(F.count("*").alias("events"))


# --- Delivery ------------------------------------------------------------------------------------------------------------------

SHARDED = LOG + ", sharded AS (SELECT event_id % 7 AS shard, event_id, row_number() OVER (PARTITION BY event_id % 7 ORDER BY event_id) - 1 AS n FROM log)"


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.assign_batches(rl.request_log(spark, sf_dir).withColumn("shard", F.col("event_id") % 7), "shard", ["event_id"], 25)


@query(SHARDED + " SELECT shard, event_id, (n // 25)::INT AS batch_no, (n % 25)::INT AS position FROM sharded")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharded(spark, sf_dir).select("shard", "event_id", "batch_no", "position")


BODIES = SHARDED + """, bodies AS (SELECT shard, (n // 25)::INT AS batch_no, count(*)::INT AS events, '{"events":[' || string_agg('{"id":' || event_id || '}', ',' ORDER BY n) || ']}' AS body FROM sharded GROUP BY 1, 2)"""


@query(BODIES + f" SELECT shard, batch_no, events, body, 'sha256=' || {hmac_sql(text('1700000000.') + ' || body')} AS signature FROM bodies")
def delivery_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = delivery.envelopes(_sharded(spark, sf_dir).withColumn("event", F.to_json(F.struct(F.col("event_id").alias("id")))), "shard")
    signed = b.withColumn("site", F.lit("main")).join(F.broadcast(test_keys(spark)), "site")
    return signed.select("shard", "batch_no", "events", "body", delivery.signature(F.lit("1700000000"), F.col("body"), F.col("ipad"), F.col("opad")).alias("signature"))


def json_of(x: str) -> str:
    return f"to_json({x})::VARCHAR"


def json_member(name: str, x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '' ELSE ',\"{name}\":' || {json_of(x)} END"


EVENT_SQL = CLASSED + f""", cleaned AS MATERIALIZED (SELECT event_id, {ISO} AS iso, path, {cleaned("search")} AS search, {METHOD} AS method, user_agent, {STRIPPED} AS referer, provider, agent_type, confidence, matched_by
  FROM classed WHERE provider <> 'other'), rendered AS (
  SELECT event_id % 7 AS shard, row_number() OVER (PARTITION BY event_id % 7 ORDER BY event_id) - 1 AS n,
    '{{"schemaVersion":1,"eventKind":"request_observation","sourceProvider":"nginx_log_forwarder","observedAt":' || {json_of("iso")} || ',"request":{{"host":"unknown.local","path":' || {json_of("path")}
    || {json_member("search", "search")} || ',"method":' || {json_of("method")} || {json_member("userAgent", "user_agent")} || {json_member("referer", "referer")}
    || '}},"providerClassification":{{"provider":"' || provider || '","agentType":"' || agent_type || '","confidence":' || confidence::VARCHAR || ',"matchedBy":["' || matched_by
    || '"]}},"integration":{{"kind":"nginx_log_forwarder","name":"nginx-log-forwarder"}}}}' AS event FROM cleaned
), posted AS (SELECT shard, (n // 50)::INT AS batch_no, count(*)::INT AS events, '{{"events":[' || string_agg(event, ',' ORDER BY n) || ']}}' AS body FROM rendered GROUP BY 1, 2)"""


@query(EVENT_SQL + f" SELECT shard, batch_no, events, body, 'sha256=' || {hmac_sql(text('2024-01-01T00:00:00.000Z.') + ' || body')} AS signature FROM posted")
def delivery_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From log lines to signed envelopes."""
    o = nginx_to_observations(rl.common_lines(rl.request_log(spark, sf_dir)), query="keep", carry=("event_id",)).withColumns({"shard": F.col("event_id") % 7, "own": F.lit("main")})
    sent = jobs.delivery_job(o, "shard", ["event_id"], test_keys(spark), "own", F.lit("2024-01-01T00:00:00.000Z"), 50)
    return sent.select("shard", "batch_no", "events", "body", "signature")


@query(CLASSED + f""" SELECT event_id, '{{"probe":{{"schemaVersion":1,"eventKind":"setup_probe","sourceProvider":"vercel","observedAt":' || {json_of(ISO)} || ',"probe":{{"id":"p' || event_id || '","token":"t"}},"request":{{"host":' || {json_of("host")}
  || ',"path":"/__setup-probe"' || {json_member("search", "search")} || ',"method":' || {json_of(METHOD)} || {json_member("userAgent", "user_agent")} || {json_member("referer", "referer")}
  || '}},"integration":{{"kind":"vercel_nextjs_middleware","name":"vercel-middleware","requestId":"r' || event_id || '"}}}}}}' AS body FROM classed WHERE {IS_PROBE}""")
def probe_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = jobs.observe_probes(rl.request_records(rl.request_log(spark, sf_dir)), "vercel", carry=("event_id",))
    return delivery.probe_envelopes(probes).select("event_id", "body")


CODES = [200, 204, 401, 403, 408, 409, 425, 429, 500, 503, 404, 0]


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.nullif(F.element_at(F.array(*map(F.lit, CODES)), (F.col("event_id") % len(CODES) + 1).cast("int")), F.lit(0))
    return delivery.outcomes(rl.request_log(spark, sf_dir).select((F.col("event_id") / 3).cast("long").alias("batch_id"), (F.col("event_id") % 3 + 1).alias("attempt"), code.alias("status")))


ATTEMPTS = LOG + f""", sent AS (SELECT event_id // 3 AS batch_id, event_id % 3 + 1 AS attempt, nullif({pick(CODES)}, 0) AS status FROM log), attempts AS (
  SELECT *, coalesce(status BETWEEN 200 AND 299, false) AS ok, coalesce(status IN (401, 403), false) AS auth_failure, status IS NULL OR status IN (408, 409, 425, 429) OR status >= 500 AS retryable FROM sent
)"""


@query(ATTEMPTS + " SELECT batch_id, attempt, ok, auth_failure, retryable FROM attempts")
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir).select("batch_id", "attempt", "ok", "auth_failure", "retryable")


@query(ATTEMPTS + " SELECT batch_id, attempt, CASE WHEN retryable AND attempt <= 2 THEN least(1000, 100 * 2 ** (attempt - 1))::BIGINT END AS next_delay_ms FROM attempts")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.retry_schedule(_attempts(spark, sf_dir)).select("batch_id", "attempt", "next_delay_ms")


@query(ATTEMPTS + " SELECT batch_id, max(attempt) AS attempts, arg_max(coalesce(status, -1), attempt) AS status, arg_max(ok, attempt) AS ok FROM attempts GROUP BY 1")
def latest_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.latest_attempts(_attempts(spark, sf_dir)).withColumn("status", F.coalesce("status", F.lit(-1)))


# --- Rules and streams ---------------------------------------------------------------------------------------------------------


@query(CLASSED + f" SELECT id, count(rule) AS matched FROM (SELECT unnest({listed([r.id for r in ALL_RULES])}) AS id) LEFT JOIN classed ON rule = id GROUP BY 1")
def rule_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule of the registry is the one that classifies a request; a rule that never is has 0."""
    ids = rules_table(spark).select("id").distinct()
    hit = classed(spark, sf_dir).groupBy(F.col("class.matched_rule").alias("id")).agg(F.count("*").alias("matched"))
    return ids.join(hit, "id", "left").select("id", F.coalesce("matched", F.lit(0)).alias("matched"))


@query(ORACLES["provider_bucket_rollup"])
def stream_nginx_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup again, over what a stream of the same lines has written."""
    from .streaming.jobs import stream_nginx

    root = scratch(spark)
    rl.common_lines(rl.request_log(spark, sf_dir)).select("value").write.text(f"{root}/in")
    stream_nginx(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return rollups.by_bucket(spark.read.parquet(f"{root}/out"))


from . import queries_io  # noqa: E402, F401  registers the rest, from what stands above
