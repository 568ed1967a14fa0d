"""Goldens and edge cases of parsers, classification, privacy, validation, delivery and streams."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from traffic_signals import requestlog as rl
from traffic_signals.functions import rules
from traffic_signals.functions.exprs import form_decode, jtrim, strict_iso
from traffic_signals.functions.urls import authority, parse_url
from traffic_signals.operators import delivery, rollups
from traffic_signals.operators.classify import with_request_class
from traffic_signals.operators.privacy import allow_headers, hmac_pads, hmac_sha256, sanitize_for_delivery
from traffic_signals.plans.jobs import cloudfront_to_observations, delivery_job, nginx_to_observations
from traffic_signals.sources.cloudfront import decode_envelopes, parse_cloudfront, read_cloudfront
from traffic_signals.sources.nginx import parse_nginx, read_nginx, split_errors
from traffic_signals.sources.requests import page_route
from traffic_signals.sources.sinks import side_output, write_dead_letters, write_observations, write_outbox
from traffic_signals.streaming.jobs import stream_cloudfront, stream_nginx, stream_rollup

CASES = [
    # user agent, referer, search -> provider, rule
    ("Mozilla/5.0 (compatible; OAI-SearchBot/1.0)", None, None, "openai_search_bot", "ua:openai:oai-searchbot"),
    ("GPTBot/1.1", "https://www.google.com/search?q=a", "?utm_source=chatgpt.com", "openai_gptbot", "ua:openai:gptbot"),
    ("éGPTBot", None, None, "openai_gptbot", "ua:openai:gptbot"),
    ("xGPTBot", None, None, "other", "fallback:unknown-request"),
    ("Mozilla/5.0", "https://chatgpt.com/", None, "openai_chatgpt_referral", "ref:openai:chatgpt"),
    ("Mozilla/5.0", "https://chatgpt.com?x=1", None, "other", "fallback:unknown-request"),
    ("Mozilla/5.0", "https://evil.com?x.chatgpt.com/", None, "openai_chatgpt_referral", "ref:openai:chatgpt"),
    (None, "https://grok.com/", "?utm_source=chatgpt", "xai_grok_referral", "ref:xai:grok"),
    (None, "https://poe.com/x", "?utm_source=chatgpt", "openai_chatgpt_referral", "query:openai:chatgpt"),
    (" ", " ", "https://a.example/?x=1&SOURCE=https://www.chatgpt.com/a", "openai_chatgpt_referral", "query:openai:chatgpt"),
    ("-", None, "?utm_source=cha%3Atgpt.com", "openai_chatgpt_referral", "query:openai:chatgpt"),
    (None, None, "?q=chatgpt", "other", "fallback:unknown-request"),
    (None, None, "?utm_source=%E0%A4%A", "other", "fallback:unknown-request"),
    (None, None, None, "other", "fallback:unknown-request"),
]


def test_classification_goldens(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, user_agent string, referer string, search string")
    got = {r["i"]: (r["class"]["provider"], r["class"]["matched_rule"]) for r in with_request_class(df).collect()}
    assert got == {i: c[3:] for i, c in enumerate(CASES)}


def test_guards_cover_the_rules():
    import re

    for r in rules.USER_AGENT_RULES:
        for p in r.patterns:
            assert re.search(rules.USER_AGENT_GUARD, re.sub(r"\\b|\(\?:.*", "", p)), r.id
    assert all(p.startswith("^https?") for r in rules.REFERER_RULES for p in r.patterns)


def test_rules_round_trip(spark, tmp_path):
    rules.write_rules(spark, str(tmp_path / "rules"))
    assert rules.read_rules(spark, str(tmp_path / "rules")) == {"user_agent": rules.USER_AGENT_RULES, "referer": rules.REFERER_RULES, "query": rules.QUERY_RULES}


def test_own_rules_classify(spark, tmp_path):
    own = {"user_agent": [rules.Rule("ua:own", "other_bot", "ai_search_crawler", 0.5, (r"\bownbot\b",))]}
    rules.write_rules(spark, str(tmp_path / "own"), own)
    df = spark.createDataFrame([("OwnBot/1", None, None), ("GPTBot", "https://chatgpt.com/", None)], "user_agent string, referer string, search string")
    got = [r["class"]["matched_rule"] for r in with_request_class(df, rules=rules.read_rules(spark, str(tmp_path / "own"))).collect()]
    assert got == ["ua:own", "ref:openai:chatgpt"]


def test_rule_differences(spark):
    """Two tables of rules are compared both ways."""
    ours = rules.rules_table(spark)
    assert rules.rule_differences(ours, ours).count() == 0
    changed = {"user_agent": [*rules.USER_AGENT_RULES[1:], rules.Rule("ua:new", "x", "y", 0.1, ("a",))], "query": [rules.Rule(**{**vars(rules.QUERY_RULES[0]), "patterns": ("b",)})]}
    gone, new, query = rules.USER_AGENT_RULES[0].id, "ua:new", rules.QUERY_RULES[0].id
    got = {r["id"]: (r["ours"] is None, r["theirs"] is None) for r in rules.rule_differences(ours, rules.rules_table(spark, changed)).collect()}
    assert got[gone] == (False, True) and got[new] == (True, False) and got[query] == (False, False)


# Typed apart from the registry: what known agents, referers and queries must be classified as.
KNOWN = {
    "user_agent": {
        "Mozilla/5.0 (compatible; OAI-SearchBot/1.0; +https://openai.com/searchbot)": ("openai_search_bot", "ai_search_crawler"), "Mozilla/5.0 (compatible; GPTBot/1.2)": ("openai_gptbot", "ai_training_crawler"),
        "Mozilla/5.0 ChatGPT-User/1.0": ("openai_chatgpt_user", "ai_browser_user"), "ClaudeBot/1.0": ("anthropic_claudebot", "ai_training_crawler"), "Claude-User/1.0": ("anthropic_claude_user", "ai_browser_user"),
        "Claude-SearchBot/1.0": ("anthropic_claude_search_bot", "ai_search_crawler"), "PerplexityBot/1.0": ("perplexitybot", "ai_search_crawler"), "Perplexity-User/1.0": ("perplexity_user", "ai_browser_user"),
    },
    "referer": {
        "https://chatgpt.com/": "openai_chatgpt_referral", "https://claude.ai/chat/1": "anthropic_claude_referral", "https://www.perplexity.ai/search": "perplexity_referral", "https://gemini.google.com/app": "google_gemini_referral",
        "https://copilot.microsoft.com/": "microsoft_copilot_referral", "https://grok.com/": "xai_grok_referral", "https://chat.mistral.ai/chat": "mistral_le_chat_referral", "https://www.meta.ai/": "meta_ai_referral",
    },
    "search": {"?utm_source=chatgpt.com": "openai_chatgpt_referral", "https://example.com/?utm_source=chatgpt": "openai_chatgpt_referral", "?source=chat.openai.com": "openai_chatgpt_referral"},
}


def test_known_visitors(spark):
    rows = [(v if k == "user_agent" else None, v if k == "referer" else None, v if k == "search" else None) for k, vs in KNOWN.items() for v in vs]
    df = with_request_class(spark.createDataFrame(rows, "user_agent string, referer string, search string"))
    got = {r["user_agent"] or r["referer"] or r["search"]: r["class"] for r in df.collect()}
    for v, (provider, kind) in KNOWN["user_agent"].items():
        assert (got[v]["provider"], got[v]["agent_type"], got[v]["matched_by"]) == (provider, kind, "user_agent")
    for k in ("referer", "search"):
        for v, provider in KNOWN[k].items():
            assert (got[v]["provider"], got[v]["agent_type"]) == (provider, "ai_referral_visit")


def test_typed_validation_agrees_with_the_contract(spark, data):
    from traffic_signals.operators.validate import valid_observation, validate_events
    from traffic_signals.plans.jobs import observe_requests

    o = observe_requests(rl.request_records(rl.request_log(spark, data)), "vercel", carry=("event_id",))
    k = F.col("event_id") % 12
    broken = {"host": (1, ""), "path": (2, "x"), "search": (3, "q"), "method": (4, "get"), "country": (5, "us"), "region": (6, ""), "request_id": (7, ""), "observed_at": (8, "2024-02-31T00:00:00Z"), "source_provider": (9, "x"), "integration_name": (10, ""), "integration_kind": (11, "x")}
    o = o.withColumns({c: F.when(k == n, F.lit(v)).otherwise(F.col(c)) for c, (n, v) in broken.items()})
    rows = validate_events(delivery.canonical_json(o).withColumn("typed", valid_observation())).select((F.size("issues") == 0).alias("json"), "typed").collect()
    assert all(r["json"] == r["typed"] for r in rows) and {r["typed"] for r in rows} == {True, False}


def test_unknown_fields_keep_their_order(spark):
    from traffic_signals.operators.validate import validate_probe_responses

    df = spark.createDataFrame([('{"zz":1,"ok":true,"aa":null,"eventKind":"setup_probe","probeId":"a","receivedAt":"2024-01-01T00:00:00Z"}',)], "event string")
    assert validate_probe_responses(df).first()["issues"] == ["response.zz is not allowed", "response.aa is not allowed"]


def test_collection_is_switched_on_by_exact_words(spark):
    from traffic_signals.sources.requests import tracked

    df = spark.createDataFrame([("1",), ("true",), ("TRUE",), (" yes",), ("on",), (None,), ("0",)], "enabled string")
    assert [r[0] for r in tracked(df).collect()] == ["1", "true", "on"]


def test_expressions(spark):
    df = spark.createDataFrame([("\u00a0 a\u2003", "a+b%20c", "2024-02-29T23:59:59.123456Z"), ("x", "%zz+", "2023-02-29T00:00:00Z"), ("", "%FF+", "2024-01-01T00:00:60Z"), (None, None, None)], "t string, f string, i string")
    got = [tuple(r) for r in df.select(jtrim(F.col("t")), form_decode(F.col("f")), strict_iso(F.col("i"))).collect()]
    assert got == [("a", "a b c", True), ("x", "%zz+", False), ("", "%FF+", False), (None, None, False)]


NGINX = [
    ('1.2.3.4 - - [10/Oct/2024:13:55:36 +0200] "GET /a?b=1 HTTP/1.1" 200 12 "https://x.example/?q" "GPTBot/1.0" extra', None, "/a", "?b=1"),
    ('1.2.3.4 - - [10/Oct/2024:13:55:36 +0200] "GET http://h.example HTTP/1.1" - -', None, "/", None),
    ('1.2.3.4 - - [10/MAY/2024:13:55:36 +0200] "GET / HTTP/1.1" 200 1', "missing_timestamp", None, None),
    ('1.2.3.4 - - [31/Feb/2024:13:55:36 +0200] "GET / HTTP/1.1" 200 1', "missing_timestamp", None, None),
    ('1.2.3.4 - - [10/Oct/2024:13:55:36 +0200] "-" 400 0', "malformed_request", None, None),
    ("nonsense", "malformed_line", None, None),
    ("", "empty_line", None, None),
    (None, "empty_line", None, None),
    ('{"a":', "malformed_json", None, None),
    ('{"request":"GET / HTTP/1.1","msec":1.5} x', "malformed_json", None, None),
    ('{"request":"GET /q HTTP/1.1","msec":"1700000000.25"}', None, "/q", None),
    ('{"request":"-","method":"GET","uri":"/fall?x","time":"2024-01-01T00:00:00Z"}', None, "/fall", "?x"),
    ('{"request":"GET","method":"GET","uri":"/fall","time":"2024-01-01T00:00:00Z"}', "malformed_request", None, None),
    ('{"method":"GET","uri":"/t"}', "missing_timestamp", None, None),
]


def test_nginx_lines(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(NGINX)], "i int, value string")
    got = {r["i"]: (r["error"], r["path"], r["search"]) for r in parse_nginx(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(NGINX)}
    assert {r["error"] for r in parse_nginx(df.where("i = 0"), "xml").collect()} == {"unsupported_format"}
    entries, dead = split_errors(parse_nginx(df))
    assert (entries.count(), dead.count()) == (4, 10)
    with pytest.raises(Exception, match="malformed log line"):
        split_errors(parse_nginx(df), "FAILFAST")[0].collect()
    assert parse_nginx(df.limit(0)).count() == 0


def test_first_present_key_counts(spark):
    df = spark.createDataFrame([('{"request":"GET / HTTP/1.1","msec":1,"http_referer":"-","referer":"https://claude.ai/","status":200.0,"bytes_sent":"12ab"}',)], "value string")
    r = parse_nginx(df).first()
    assert (r["referer"], r["status"], r["bytes_sent"]) == (None, 200, 12)


def test_cloudfront_second_question_mark(spark):
    line = "\t".join(["1700000000.123", "1.1.1.1", "200", "GET", "https", "h.example", "/p?a=1?b", "id", "GPTBot", "-", "-", "us"])
    r = parse_cloudfront(spark.createDataFrame([(line + "\n",)], "value string")).first()
    assert (r["path"], r["search"], r["country"], r["error"]) == ("/p", "?a=1", None, None)
    bad = decode_envelopes(spark.createDataFrame([("!!!",), (None,)], "data string"))
    assert [r["error"] for r in parse_cloudfront(bad).collect()] == ["undecodable"] * 2


@pytest.mark.parametrize("secret", ["k", "s" * 64, "long " * 30, "ключ"])
def test_hmac(spark, secret):
    ipad, opad = hmac_pads(F.lit(secret))
    got = spark.range(1).select(hmac_sha256(F.lit("10.0.0.1"), ipad, opad)).first()[0]
    assert got == hmac.new(secret.encode(), b"10.0.0.1", hashlib.sha256).hexdigest()


def test_salts_are_in_no_plan(spark):
    from traffic_signals.operators.privacy import Policy, apply_privacy

    keys = spark.createDataFrame([("main", "k1", b"\x36" * 64, b"\x5c" * 64)], "site string, key_id string, ipad binary, opad binary")
    obs = nginx_to_observations(rl.common_lines(rl.request_log(spark, "/root/testdata/sf0.001"))).withColumn("client_ip", F.lit("10.0.0.1"))
    out = apply_privacy(obs, Policy(query="omit", ip="hash", truncated_bits=128), keys=keys, site=F.lit("main"))
    assert "client_ip" not in out.columns
    h = out.first()["ip_hash"]
    assert (h["algorithm"], len(h["value"]), h["original_ip_retention"]) == ("hmac-sha256", 32, "discarded_after_hash")


def test_headers_last_wins(spark):
    df = spark.createDataFrame([([("Referer", "https://a.example/?x"), ("X-A", " "), ("x-a", "2"), ("secret", "s")],)], "e array<struct<key:string,value:string>>")
    got = df.select(allow_headers(F.map_from_entries("e"), ["referer", "X-A"])).first()[0]
    assert got == {"referer": "https://a.example/", "x-a": "2"}


def test_sanitation_is_idempotent(spark, data):
    obs = nginx_to_observations(rl.common_lines(rl.request_log(spark, data)), query="keep")
    once = sanitize_for_delivery(obs)
    assert once.exceptAll(sanitize_for_delivery(once)).count() == 0
    assert once.where("search like '%token%' and class.agent_type = 'ai_referral_visit'").count() == 0


def test_batches(spark):
    df = spark.range(5).withColumn("s", F.lit("f"))
    got = [(r["batch_no"], r["position"]) for r in delivery.assign_batches(df, "s", ["id"], 2).orderBy("id").collect()]
    assert got == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    with pytest.raises(ValueError):
        delivery.assign_batches(df, "s", ["id"], 0)


def test_routes_and_urls(spark):
    df = spark.createDataFrame([("/a", "https://U:p@H.example:443/x"), ("/api/b", "http://h.example:8080"), ("/b.png", "nothing")], "p string, u string")
    assert [tuple(r) for r in df.select(page_route(F.col("p")), authority(parse_url(F.col("u")))).collect()] == [(True, "h.example"), (False, "h.example:8080"), (False, None)]


def test_stream_equals_batch(spark, data, tmp_path):
    rl.common_lines(rl.request_log(spark, data)).select("value").repartition(3).write.text(str(tmp_path / "in"))
    stream_nginx(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = nginx_to_observations(read_nginx(spark, str(tmp_path / "in")))
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    assert batch.count() == streamed.count() > 0
    assert batch.drop("class", "ip_hash").exceptAll(streamed.drop("class", "ip_hash")).count() == 0
    # What a failed run has left is replaced, and files that were taken are not taken again.
    stream_nginx(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count()
    stream_nginx(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp-lost")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count()
    # A file that comes later under a new name is the only one read.
    rl.common_lines(rl.request_log(spark, data).limit(20)).select("value").coalesce(1).write.text(str(tmp_path / "late"))
    (part,) = (tmp_path / "late").glob("part-*")
    part.rename(tmp_path / "in" / "rotated.txt")
    stream_nginx(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == nginx_to_observations(read_nginx(spark, str(tmp_path / "in"))).count() > batch.count()


def test_stream_rollup(spark, data, tmp_path):
    log = rl.request_log(spark, data)
    late = log.limit(1).withColumns({"stamp": F.lit("2035-01-01").cast("timestamp"), "event_id": F.lit(0).cast("long")})
    for i, part in enumerate((log, late)):  # the watermark of the last file closes the windows of the first
        rl.common_lines(part).select("value").coalesce(1).write.text(str(tmp_path / f"p{i}"))
    (tmp_path / "in").mkdir()
    for i in range(2):
        (file,) = (tmp_path / f"p{i}").glob("part-*")
        file.rename(tmp_path / "in" / f"{i}.txt")
        stream_rollup(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r["start"], r["bucket"], r["family"]): r["visits"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = rollups.by_bucket(with_request_class(log).withColumn("start", F.date_trunc("hour", "stamp")), "start").collect()
    assert got == {(r["start"], r["bucket"], r["family"]): r["visits"] for r in want}


def test_stream_of_cdn_lines(spark, data, tmp_path):
    lines = rl.cloudfront_lines(rl.request_log(spark, data))
    lines.select("value").write.text(str(tmp_path / "in"))
    stream_cloudfront(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = cloudfront_to_observations(read_cloudfront(spark, str(tmp_path / "in")))
    assert spark.read.parquet(str(tmp_path / "out")).drop("class", "ip_hash", "batch_id").exceptAll(batch.drop("class", "ip_hash")).count() == 0 < batch.count()


def test_outbox_and_side_outputs(spark, data, tmp_path):
    import json

    obs = nginx_to_observations(rl.common_lines(rl.request_log(spark, data))).withColumns({"shard": F.lit(1), "own": F.lit("main")})
    keys = spark.createDataFrame([("main", b"\x36" * 64, b"\x5c" * 64)], "site string, ipad binary, opad binary")
    sent = delivery_job(obs, "shard", ["observed_at"], keys, "own", F.lit("t"))
    write_outbox(sent.select("body", "signature"), str(tmp_path / "outbox"))
    bodies = [json.loads(r["body"])["events"] for r in spark.read.json(str(tmp_path / "outbox")).collect()]
    assert sum(map(len, bodies)) == obs.count() and max(map(len, bodies)) == 100
    assert not any("?" in e["request"].get("referer", "") for b in bodies for e in b)
    seen = []
    side_output(obs, lambda df: seen.append(df.count()), lambda df: write_observations(df.drop("ip_hash"), str(tmp_path / "o")))
    assert seen == [spark.read.parquet(str(tmp_path / "o")).count()]


def test_sinks(spark, data, tmp_path):
    obs = nginx_to_observations(rl.common_lines(rl.request_log(spark, data)))
    write_observations(obs.drop("ip_hash"), str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == obs.count()
    dead = split_errors(parse_nginx(rl.mixed_lines(rl.request_log(spark, data))))[1]
    write_dead_letters(dead, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).select("error").distinct().count() == 5
    assert rollups.by_bucket(obs).count() > 5
