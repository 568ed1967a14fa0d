"""Complete lines, repeated keys, sinks under replay, numbering, delivery rounds, look-ups and streams with failures."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from traffic_signals import queries_io, requestlog as rl
from traffic_signals.functions.rules import rules_table
from traffic_signals.operators import delivery, rollups
from traffic_signals.operators.classify import with_request_class
from traffic_signals.operators.privacy import key_table, looked_up
from traffic_signals.operators.validate import validate_events
from traffic_signals.plans.jobs import nginx_to_observations, observe_probes, observe_requests
from traffic_signals.sources.nginx import parse_nginx, read_nginx
from traffic_signals.sources.sinks import write_dead_letters, write_observations, write_outbox
from traffic_signals.streaming.jobs import PASS, PassListener, stream_envelopes, stream_nginx, stream_rollup
from traffic_signals.tables import scratch_folder

LINE = '1.2.3.4 - - [01/Jan/2024:00:00:{:02d} +0000] "GET /p{} HTTP/1.1" 200 5 "-" "GPTBot/1.0"'


def line(n):
    return LINE.format(n % 60, n)


# --- Complete lines --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("content, lines", [
    (b"", []), (b"\n", [""]), (b"a", []), (b"a\n", ["a"]), (b"a\nb", ["a"]), (b"a\r\nb\r\n", ["a", "b"]), (b"a\r\nb\r", ["a"]), ("é\nü".encode(), ["é"]), ("é\nü\n".encode(), ["é", "ü"]),
    (b"\xef\xbb\xbfa\nb\n", ["a", "b"]), (b"\xef\xbb\xbfa\nb", ["a"]), (b"a\n\n", ["a", ""]), (b"\xff\xfe\nx", [None]),
])
def test_complete_lines(spark, tmp_path, content, lines):
    (tmp_path / "a.log").write_bytes(content)
    got = [r["value"] for r in read_nginx(spark, str(tmp_path / "a.log")).collect()] if None not in lines else [None] * read_nginx(spark, str(tmp_path / "a.log")).count()
    assert got == lines


def test_tails_of_several_split_files(spark, tmp_path):
    for k in range(4):
        (tmp_path / f"{k}.log").write_text("\n".join(line(n) for n in range(400)) + ("\n" if k % 2 else "\n" + line(999)[:40]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        parsed = parse_nginx(read_nginx(spark, str(tmp_path)))
        assert parsed.count() == 1600 and parsed.where("error is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stream_leaves_tails_and_counts_a_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    mixed = [line(1), "not a line", "", line(2).replace("GPTBot/1.0", "Mozilla/5.0"), '{"request":"GET /x HTTP/1.1"}', line(3)]
    (tmp_path / "in" / "a.log").write_text("\n".join(mixed) + "\n" + line(4)[:60])
    stats = str(tmp_path / "stats")

    def run():
        stream_nginx(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), stats=stats).awaitTermination()
        return {r["batch_id"]: r.asDict() for r in spark.read.json(stats).collect()}

    assert run() == {0: {"batch_id": 0, "parsed": 3, "malformed": 2, "blank": 1, "skipped": 1, "queued": 2}}
    (tmp_path / "in" / "b.log").write_text(line(5) + "\r\n" + line(6) + "\n")
    second = run()
    assert second[1] == {"batch_id": 1, "parsed": 2, "malformed": 0, "blank": 0, "skipped": 0, "queued": 2}
    batch = with_request_class(parse_nginx(read_nginx(spark, str(tmp_path / "in"))))
    want = rollups.pass_statistics(batch).drop("batches").first().asDict()
    assert {k: sum(row[k] for row in second.values()) for k in want} == want
    assert {r["path"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"/p1", "/p3", "/p5", "/p6"}


def test_listener_sees_the_counters_of_a_stream(spark, data, tmp_path):
    lines = rl.mixed_lines(rl.request_log(spark, data))
    lines.select("value").coalesce(1).write.text(str(tmp_path / "in"))
    handed = []
    listener = PassListener(lambda *seen: handed.append(seen))
    spark.streams.addListener(listener)
    try:
        stream_rollup(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(100):
            if listener.seen:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    want = rollups.pass_statistics(with_request_class(parse_nginx(lines))).drop("batches").first().asDict()
    first = min(listener.seen, key=lambda key: key[1])
    assert listener.seen[first] == want and handed[0][2] == want and PASS == "pass_statistics"


def test_observation_of_a_batch(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(line(1),), ("x",)], "value string")
    seen = Observation("own")
    assert nginx_to_observations(df, counted=seen).count() == 1
    assert seen.get == {"parsed": 1, "malformed": 1, "blank": 0, "skipped": 0, "queued": 1}


# --- Repeated keys -----------------------------------------------------------------------------------------------------------------


def test_last_value_of_a_repeated_key(spark):
    rows = [
        '{"status":200,"status":404,"request":"GET /a HTTP/1.1","request":"POST /b HTTP/1.1","msec":1,"host":"x","host":"-"}', '{"a":{"b":1,"b":{"c":1,"c":2}},"request":"GET /a HTTP/1.1","msec":1}',
        '{"request":"GET /a HTTP/1.1","msec":1}{"x":1}', '{"request":"GET /a HTTP/1.1","msec":1,"msec":"x"}',
    ]
    got = [(r["error"], r["method"], r["path"], r["status"], r["host"]) for r in parse_nginx(spark.createDataFrame([(r,) for r in rows], "value string"), "json").collect()]
    assert got == [(None, "POST", "/b", 404, None), (None, "GET", "/a", None, None), ("malformed_json", None, None, None, None), ("missing_timestamp", None, None, None, None)]


def test_unknown_fields_under_repeated_keys(spark):
    event = '{"schemaVersion":1,"eventKind":"request_observation","sourceProvider":"manual","observedAt":"2024-01-01T00:00:00Z","providerClassification":{"provider":"other","agentType":"other","confidence":0,"matchedBy":["other"]},"request":{"aa":1},"request":{"zz":1,"host":"h","path":"/","yy":1,"method":"GET","zz":2}}'
    (row,) = validate_events(spark.createDataFrame([(event,)], "event string")).collect()
    assert sorted(row["issues"]) == ["request.yy is not allowed", "request.zz is not allowed"]


# --- Sinks and lookups -------------------------------------------------------------------------------------------------------------


def test_replayed_batches_are_written_once(spark, tmp_path):
    o = spark.createDataFrame([(f"2024-01-0{1 + n % 3}T00:00:00.000Z", n) for n in range(9)], "observed_at string, n int")
    dead, out = o.select(F.lit("x").alias("value"), (F.col("n") % 2).cast("string").alias("error")), o.select(F.col("n").cast("string").alias("body"))
    for sink, df, name in ((write_observations, o, "o"), (write_dead_letters, dead, "d"), (write_outbox, out, "b")):
        path = str(tmp_path / name)
        sink(df.limit(4), path, 0)  # what a failed run has left, other partitions included
        sink(df.where("error = '1'") if name == "d" else df.where("n % 3 = 1") if name == "o" else df.limit(2), path, 0)
        sink(df, path, 1)
        seen = (spark.read.json if name == "b" else spark.read.parquet)(path).groupBy("batch_id").count().collect()
        assert dict(map(tuple, seen)) == {0: {"o": 3, "d": 4, "b": 2}[name], 1: 9}
    write_outbox(out, str(tmp_path / "b2"))
    write_outbox(out, str(tmp_path / "b2"))
    assert spark.read.json(str(tmp_path / "b2")).count() == 18


@pytest.mark.parametrize("most", [0, 100])
def test_looked_up(spark, most):
    df = spark.createDataFrame([(n, "hot" if n % 3 else None if n % 2 else "none") for n in range(300)], "n int, k string")
    table = spark.createDataFrame([("hot", 1), ("cold", 2)], "t_k string, v int")
    got = looked_up(df, table, "k", "t_k", most)
    assert sorted((r["n"], r["v"]) for r in got.collect()) == [(n, 1 if n % 3 else None) for n in range(300)]
    assert ("__share" in got._jdf.queryExecution().toString()) is not bool(most)


def test_scratch_folders_go(spark):
    with pytest.raises(ZeroDivisionError), scratch_folder(spark) as path:
        spark.range(3).write.parquet(path)
        1 / 0
    assert not spark._jvm.java.io.File(path.removeprefix("file:")).exists()


# --- Numbering and delivery rounds -------------------------------------------------------------------------------------------------


def test_batches_of_one_hot_source(spark):
    rows = [("hot", n, n % 7) for n in range(5000)] + [("a", n, 0) for n in range(3)] + [(None, n, 0) for n in range(30)]
    df = spark.createDataFrame(rows, "s string, n int, more int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = delivery.assign_batches(df, "s", ["n"], 25).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((str(r["s"]), r["n"], r["batch_no"], r["position"]) for r in got) == sorted((str(s), n, n // 25, n % 25) for s, n, _ in rows)
    assert got[0].asDict().keys() == {"s", "n", "more", "batch_no", "position"}
    assert delivery.assign_batches(df.limit(0), "s", ["n"]).count() == 0
    with pytest.raises(ValueError):
        delivery.assign_batches(df, "s", ["n"], 0)


def test_due_batches(spark):
    outbox = spark.createDataFrame([(n, f"body{n}") for n in range(7)], "batch_id long, body string")
    tried = [(1, 1, 200), (2, 1, 503), (3, 1, 503), (3, 2, None), (4, 1, 401), (5, 1, 429), (5, 2, 503), (5, 3, 503), (6, 1, 404)]
    due = delivery.due_batches(outbox, spark.createDataFrame(tried, "batch_id long, attempt int, status int"))
    assert sorted(map(tuple, due.collect())) == [(0, "body0", 1, 0), (2, "body2", 2, 100), (3, "body3", 3, 200)]


def test_delivery_rounds_post_each_attempt_once(spark):
    outbox = spark.createDataFrame([(n,) for n in range(20)], "batch_id long")
    posted = []

    def post(due):
        posted.extend((r["batch_id"], r["attempt"]) for r in due.collect())
        return due.withColumn("status", F.when((F.col("batch_id") % 4 == 3) | (F.col("attempt") > F.col("batch_id") % 4), 200).otherwise(503))

    ledger = delivery.delivered(outbox, post).collect()
    assert sorted((r["batch_id"], r["attempt"]) for r in ledger) == sorted(posted) and len(set(posted)) == len(posted)
    assert {r["batch_id"] for r in ledger if r["ok"]} == set(range(20))
    assert max(r["attempt"] for r in ledger) == 3
    assert delivery.delivered(outbox.limit(0), post).count() == 0


# --- Streams of envelopes ----------------------------------------------------------------------------------------------------------


def _envelopes(path, first, count):
    fields = "1704067200.{:03d}\t1.2.3.4\t200\tGET\thttps\th.example\t/p{}\tr{}\tGPTBot/1.0\t-\t-\tUS"
    rows = []
    for n in range(first, first + count):
        data = "\n".join(fields.format(k, n, f"{n}-{k}") for k in range(3))
        rows.append(json.dumps({"shard": f"s{n % 2}", "sequence_number": f"{n:05d}", "data": base64.b64encode(data.encode()).decode()}))
    path.write_text("\n".join(rows) + "\n")


def test_failed_delivery_is_replayed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _envelopes(tmp_path / "in" / "a.json", 0, 6)
    keys = key_table(spark.createDataFrame([("main", "k1", "secret")], "site string, key_id string, salt string"))
    posts, broken = [], [True]

    def post(bodies, batch_id):
        posts.append((batch_id, sorted((r["shard"], r["batch_no"], r["body"], r["signature"]) for r in bodies.collect())))
        if broken:
            broken.clear()
            raise ConnectionError("away")

    def start():
        return stream_envelopes(spark, str(tmp_path / "in"), str(tmp_path / "outbox"), str(tmp_path / "cp"), keys, "main", lambda n: f"t{n}", post, size=4)

    with pytest.raises(Exception, match="away"):
        start().awaitTermination()
    start().awaitTermination()
    assert [b for b, _ in posts] == [0, 0] and posts[0] == posts[1] and len(posts[0][1]) == 6
    _envelopes(tmp_path / "in" / "b.json", 6, 2)
    start().awaitTermination()
    sent = spark.read.json(str(tmp_path / "outbox"))
    assert {r["batch_id"]: r["n"] for r in sent.groupBy("batch_id").agg(F.sum("events").alias("n")).collect()} == {0: 18, 1: 6}
    bodies = [e for r in sent.collect() for e in json.loads(r["body"])["events"]]
    assert len({e["integration"]["requestId"] for e in bodies}) == len(bodies) == 24


# --- Requests and rules ------------------------------------------------------------------------------------------------------------

RECORD = "url string, method string, headers map<string,string>, client_ip string, request_id string, geo struct<country: string, region: string>, observed_at timestamp"


@pytest.mark.parametrize("profile, url, headers, expected", [
    ("cloudflare", "https://EXAMPLE.com:443/a/../b?q=ü#f", {}, ("example.com", "/b", None)),
    ("cloudflare", "https://h.example\\x\\.\\y", {}, ("h.example", "/x/y", None)),
    ("cloudflare", "no url", {}, ("unknown", "/", None)),
    ("netlify", "https://bücher.example:8443/é", {}, ("xn--bcher-kva.example:8443", "/%C3%A9", None)),
    ("vercel", "https://h.example:8443/a b?x=1", {}, ("h.example", "/a%20b", "?x=1")),
    ("vercel", "/only", {"Host": "own.example"}, ("own.example", "/", None)),
    ("node", "/a/./b?x=1", {"Host": "Own.example:80", "X-Forwarded-Proto": "http, https"}, ("own.example", "/a/b", None)),
    ("node", "/a", {"Host": "own.example:443", "X-Forwarded-Proto": "https"}, ("own.example", "/a", None)),
    ("node", "/a", {}, ("localhost", "/a", None)),
    ("node", "//other.example/z", {"Host": "own.example"}, ("other.example", "/z", None)),
    ("wordpress", "/a/../b?x=1", {"Host": "Own.example"}, ("Own.example", "/a/../b", None)),
])
def test_urls_of_profiles(spark, profile, url, headers, expected):
    import datetime

    row = (url, "GET", {"User-Agent": "GPTBot/1.0", **headers}, None, None, None, datetime.datetime(2024, 1, 1))
    (got,) = observe_requests(spark.createDataFrame([row], RECORD), profile).collect()
    assert (got["host"], got["path"], got["search"]) == expected


def test_probe_paths_are_resolved(spark):
    import datetime

    headers = {"x-setup-probe": "1", "x-probe-id": "a", "x-probe-token": "b", "User-Agent": "GPTBot/1.0"}
    rows = [(f"https://h.example{p}", "GET", headers, None, None, None, datetime.datetime(2024, 1, 1)) for p in ("/__setup-probe", "/x/../__setup-probe?y", "/__setup-probe/")]
    df = spark.createDataFrame(rows, RECORD)
    assert [observe_probes(df, "cloudflare").count(), observe_requests(df, "cloudflare").count()] == [2, 1]


def test_parity_tells_what_differs(spark):
    ours = rules_table(spark).groupBy("id", "provider", "agent_type", "confidence").agg(F.count("*").alias("patterns"))
    theirs = queries_io.exported_rules(spark)
    assert {r["status"] for r in queries_io.rule_parity_of(ours, theirs).collect()} == {"both"}
    changed = theirs.where("id <> 'ref:openai'").withColumn("confidence", F.when(F.col("id") == "ref:meta:ai", 0.5).otherwise(F.col("confidence")))
    got = {(r["id"], r["status"]) for r in queries_io.rule_parity_of(ours, changed).where("status <> 'both'").collect()}
    assert got == {("ref:openai", "ours"), ("ref:meta:ai", "ours"), ("ref:meta:ai", "theirs")}
