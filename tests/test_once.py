"""Work that is done once: rows before they are numbered, files of events, and steps that are compiled rather than interpreted."""

import calendar
import re

import pytest
from pyspark.sql import functions as F

from traffic_signals import catalog, requestlog
from traffic_signals.functions.exprs import BLANKS, dash_null, filled, form_decode, jtrim, query_pairs, strict_iso
from traffic_signals.functions.rules import QUERY_KEYS
from traffic_signals.functions.urls import PLAIN
from traffic_signals.operators.classify import best_class, header, known_attribution
from traffic_signals.operators.delivery import assign_batches
from traffic_signals.operators.privacy import allow_pairs
from traffic_signals.operators.validate import validate_probes
from traffic_signals.sources.nginx import line_groups


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_made_once_before_they_are_numbered(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    rows = spark.range(200).select(F.lit("one").alias("source"), F.udf(seen, "long")("id").alias("id"))
    assert assign_batches(rows, "source", ["id"], 50).where("batch_no = 3 and position = 49").first()["id"] == 199
    assert made.value == 200


def test_event_files_are_read_once(spark, data):
    plan = catalog.QUERIES["event_intake"](spark, data)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan text") == 1


@pytest.mark.parametrize("name", ["observe_nginx", "observe_all_sources", "observe_vercel", "observe_cloudfront", "validate_probe_records", "validate_event_records", "provider_bucket_rollup"])
def test_nothing_is_computed_inside_inline(spark, data, name):
    """What stands in a generator is interpreted row by row."""
    inlined = re.findall(r"Generate inline\((.*)$", optimized(catalog.QUERIES[name](spark, data)), re.M)
    assert inlined and all(re.match(r"array\(__held#\d+\)\)", x) for x in inlined)


def test_headers_and_urls_are_taken_apart_once(spark, data):
    plan = optimized(catalog.QUERIES["observe_vercel"](spark, data))
    assert "map_filter" not in plan
    assert PLAIN in plan and not re.search(r"regexp_extract\([^,]+, " + re.escape(PLAIN), plan)


ODD = ["", " ", "-", " - ", "--", "a", " a", "a ", "a\n", "\na b\n", " x　", "é", "é ", "x ", "a\n\nb", "~", "!", "\x7f", "\x00", "﻿-", None]


def test_trimming_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    got = df.select("t", jtrim(F.col("t")).alias("j"), filled(F.col("t")).alias("f"), dash_null(F.col("t")).alias("d")).orderBy("i").collect()
    for t, j, f, d in got:
        own = None if t is None else t.strip(BLANKS)
        assert (j, f, d) == (own, own or None, None if own in (None, "", "-") else own), repr(t)


def test_pairs_and_attribution(spark):
    texts = ["?a=b=c&=x&y&z=&a", "?utm%5Fsource=chatgpt.com", "?UTM_SOURCE=ChatGPT", "?s%6furce=chatgpt", "?q=chatgpt", "utm_source=+chatgpt+", "?source=x&source=chatgpt", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(query_pairs(F.col("t")).alias("p"), known_attribution(F.col("t")).alias("k"), allow_pairs(F.col("t"), F.array(F.lit("a"), *map(F.lit, QUERY_KEYS))).alias("a")).orderBy(df.i).collect()
    assert [(p["key"], p["value"], p["raw"]) for p in got[0].p] == [("a", "b=c", "a=b=c"), ("", "x", "=x"), ("y", "", "y"), ("z", "", "z="), ("a", "", "a")]
    assert [r.k for r in got] == [None, "chatgptcom", "chatgpt", "chatgpt", None, "chatgpt", "chatgpt", None, None]
    assert [r.a for r in got] == ["?a=b=c&a", "?utm%5Fsource=chatgpt.com", None, "?s%6furce=chatgpt", None, "?utm_source=+chatgpt+", "?source=x&source=chatgpt", None, None]
    forms = spark.createDataFrame([("a+b",), ("a%20b",), ("%zz+",), ("%ff",), ("�",), ("plain",)], "t string")
    assert [r[0] for r in forms.select(form_decode(F.col("t"))).collect()] == ["a b", "a b", "%zz+", "%ff", "�", "plain"]


def test_headers_by_any_case(spark):
    df = spark.sql("select map('HOST', ' h ', 'X-a', ' ', 'x-B', ' b', 'host', 'second') h union all select cast(null as map<string,string>)")
    got = df.select(header(F.col("h"), "host"), header(F.col("h"), "x-a", "x-b"), header(F.col("h"), "x-b", trim=False), header(F.col("h"), "none")).collect()
    assert [tuple(r) for r in got] == [("h", "b", " b", None), (None,) * 4]


def test_best_class_and_ties(spark):
    of = lambda p, a, c: f"named_struct('provider', '{p}', 'agent_type', '{a}', 'confidence', {c}D, 'matched_rule', '{p}', 'matched_by', 'x', 'docs_url', cast(null as string))"
    known = [of("a", "t", 0.5), of("b", "t", 0.5), of("other", "t", 0.9), of("c", "other", 0.9), of("d", "t", 0.7)]
    for picked, best in (((0, 1, 2), "a"), ((2, 1, 0), "b"), ((2, 3, 2), "other"), ((0, 3, 4), "d"), ((3, 0, 4), "d"), ((4, 0, 1), "d")):
        df = spark.sql("select " + ", ".join(f"{known[i]} c{n}" for n, i in enumerate(picked)))
        assert df.select(best_class(F.col("c0"), F.col("c1"), F.col("c2")).alias("b")).first().b.provider == best


def test_lines_that_look_like_cut_ones(spark):
    good = '1.1.1.1 - - [01/May/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 5 "r" "ua" rest'
    bad = '" ]1" ]2" ]3" ]4" ]5" ]6" ]7'
    df = spark.createDataFrame([(good,), (bad,), (good.replace(' "r" "ua" rest', ""),)], "t string")
    a, b, c = (r[0] for r in df.select(line_groups(F.col("t"))).collect())
    assert a == [" ", "1.1.1.1", "01/May/2024:00:00:00 +0000", "GET / HTTP/1.1", "200", "5", "r", "ua"] and b[0] != " " and c[-2:] == ["", ""]


def test_numbers_are_read_from_numbers_only(spark):
    good = '"eventKind":"setup_probe","sourceProvider":"vercel","observedAt":"2024-01-01T00:00:00Z","probe":{"id":"a","token":"b"},"request":{"host":"h","path":"/","method":"GET"}'
    versions = ["1", '"1"', "1.5", "0", "1e0", "null", "true", "[1]"]
    df = spark.createDataFrame([(i, '{"schemaVersion":' + v + "," + good + "}") for i, v in enumerate(versions)], "i int, event string")
    no = "schemaVersion must be an integer"
    assert [r.issues for r in validate_probes(df).orderBy("i").collect()] == [[], [no], [no], ["schemaVersion must be >= 1"], [], [no], [no], [no]]


def test_tasks_are_cut_by_rows(spark, data, monkeypatch):
    """However narrow the rows are: what a task of the sink sorts does not grow with the table."""
    before = sorted(map(tuple, catalog.QUERIES["observation_sink"](spark, data).collect()))
    monkeypatch.setattr(requestlog, "TASK_ROWS", 100)
    log = requestlog.request_log(spark, data)
    rows = [r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) > 8 and sum(rows) == spark.read.parquet(f"{data}/events.parquet").count() and max(rows) < sum(rows) / 4
    assert sorted(map(tuple, catalog.QUERIES["observation_sink"](spark, data).collect())) == before
    assert [requestlog.tasks_for(spark, n) for n in (0, 400, 401, 1_200)] == [4, 4, 8, 12]


def test_checks_search_no_names_and_read_no_days(spark, data):
    plan = optimized(catalog.QUERIES["validate_probe_records"](spark, data))
    assert "exists(" not in plan and "gettimestamp" not in plan.lower() and "date_format" not in plan


def test_days_of_the_calendar(spark):
    years = (0, 1, 4, 100, 400, 1900, 1996, 2000, 2023, 2024, 2100, 9996, 9999)
    days = [(y, m, d) for y in years for m in range(14) for d in range(33)]
    df = spark.createDataFrame([(*x, "%04d-%02d-%02dT00:00:00Z" % x) for x in days], "y int, m int, d int, t string")
    got = {(y, m, d) for y, m, d in df.where(strict_iso(F.col("t"))).select("y", "m", "d").collect()}
    assert got == {(y, m, d) for y, m, d in days if 1 <= m <= 12 and 1 <= d <= (29 if m == 2 and calendar.isleap(y) else 28 if m == 2 else calendar.mdays[m])}
    odd = spark.createDataFrame([(t,) for t in ("2024-01-01", "2024-01-01T00:00:00", "x2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z\n", "12024-01-01T00:00:00Z", None)], "t string")
    assert [r[0] for r in odd.select(strict_iso(F.col("t"))).collect()] == [False] * 6


def test_unknown_fields_beside_absent_and_repeated_ones(spark):
    rest = '"schemaVersion":1,"eventKind":"setup_probe","sourceProvider":"vercel","observedAt":"2024-01-01T00:00:00Z","request":{"host":"h","path":"/","method":"GET"}'
    probes = ['{"id":"a","x":1}', '{"id":"a","token":"b","id":"c"}', '{"id":null,"token":"b","y":null}', "{}"]
    df = spark.createDataFrame([(i, "{" + rest + ',"probe":' + p + "}") for i, p in enumerate(probes)], "i int, event string")
    no = lambda n: f"{n} must be a non-empty string"
    assert [r.issues for r in validate_probes(df).orderBy("i").collect()] == [["probe.x is not allowed", no("token")], [], ["probe.y is not allowed", no("id")], [no("id"), no("token")]]
