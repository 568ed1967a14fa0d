"""URL parsing against fixed results of the WHATWG URL standard."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from traffic_signals.functions import urls

# url, host, port, path, search; None for what is no URL.
GOLDEN = [
    ("https://EXAMPLE.com:443/a/../b", "example.com", None, "/b", None),
    ("https://example.com", "example.com", None, "/", None),
    ("http://example.com:8080?x=1#f", "example.com", "8080", "/", "?x=1"),
    ("http://example.com:80/", "example.com", None, "/", None),
    ("https://example.com:80/", "example.com", "80", "/", None),
    ("https://example.com/a b/é?q=ü", "example.com", None, "/a%20b/%C3%A9", "?q=%C3%BC"),
    ("https://example.com\\x\\..\\y?a\\b", "example.com", None, "/y", "?a\\b"),
    ("https:\\\\example.com\\p", "example.com", None, "/p", None),
    ("https:example.com/p", "example.com", None, "/p", None),
    ("https:////example.com/p", "example.com", None, "/p", None),
    ("https://example.com/./p", "example.com", None, "/p", None),
    ("https://example.com/p/.", "example.com", None, "/p/", None),
    ("https://example.com/p/..", "example.com", None, "/", None),
    ("https://example.com/a/b/../../../../c", "example.com", None, "/c", None),
    ("https://example.com/a//../b", "example.com", None, "/a/b", None),
    ("https://example.com/%2E%2e/x/%2e/y", "example.com", None, "/x/y", None),
    ("https://example.com/...", "example.com", None, "/...", None),
    ("https://example.com/a%zz%41", "example.com", None, "/a%zz%41", None),
    ("https://bücher.example/ü", "xn--bcher-kva.example", None, "/%C3%BC", None),
    ("https://BÜCHER.Example/", "xn--bcher-kva.example", None, "/", None),
    ("https://日本語。jp/", "xn--wgv71a119e.jp", None, "/", None),
    ("https://user:p@ss@example.com/", "example.com", None, "/", None),
    ("https://ex%41mple.com/", "example.com", None, "/", None),
    ("https://example.com/?", "example.com", None, "/", None),
    ("https://example.com/?#x", "example.com", None, "/", None),
    ("https://example.com/?a='b' \"c\"<d>`{}|^", "example.com", None, "/", "?a=%27b%27%20%22c%22%3Cd%3E`{}|^"),
    ("https://example.com/'\"<>`{}|^[]", "example.com", None, "/'%22%3C%3E%60%7B%7D|%5E[]", None),
    ("  https://example.com/x \n", "example.com", None, "/x", None),
    ("https://exa\tmple.com/a\nb", "example.com", None, "/ab", None),
    ("https://example.com/a?b?c#d?e", "example.com", None, "/a", "?b?c"),
    ("https://example.com/🙂", "example.com", None, "/%F0%9F%99%82", None),
    ("https://192.168.0.1/", "192.168.0.1", None, "/", None),
    ("https://0x7f.1/", "127.0.0.1", None, "/", None),
    ("https://017700000001/", "127.0.0.1", None, "/", None),
    ("https://3232235521/", "192.168.0.1", None, "/", None),
    ("https://1.2.3/", "1.2.0.3", None, "/", None),
    ("https://1.2.3.4./", "1.2.3.4", None, "/", None),
    ("https://256.1.1.1/", None, None, None, None),
    ("https://1.2.3.4.5/", None, None, None, None),
    ("https://4294967296/", None, None, None, None),
    ("https://1.2.3.08/", None, None, None, None),
    ("https://a.09x/", "a.09x", None, "/", None),
    ("http://[::1]:3000/", "[::1]", "3000", "/", None),
    ("http://[2001:DB8:0:0:1:0:0:1]/", "[2001:db8::1:0:0:1]", None, "/", None),
    ("http://[1:0:0:2:0:0:0:3]/", "[1:0:0:2::3]", None, "/", None),
    ("http://[0:0:0:0:0:0:0:0]/", "[::]", None, "/", None),
    ("http://[1:2:3:4:5:6:7:8]/", "[1:2:3:4:5:6:7:8]", None, "/", None),
    ("http://[fe80::00ab]/", "[fe80::ab]", None, "/", None),
    ("http://[::ffff:192.0.2.1]/", "[::ffff:c000:201]", None, "/", None),
    ("http://[1:2:3]/", None, None, None, None),
    ("http://[1::2::3]/", None, None, None, None),
    ("http://[::1/", None, None, None, None),
    ("https://exa mple.com/", None, None, None, None),
    ("https://example.com:99999/", None, None, None, None),
    ("https://example.com:0080/", "example.com", "80", "/", None),
    ("https://example.com:/", "example.com", None, "/", None),
    ("https://example.com:8x/", None, None, None, None),
    ("https:///", None, None, None, None),
    ("https://", None, None, None, None),
    ("HTTPS://Example.COM/A", "example.com", None, "/A", None),
    ("ws://example.com:80/s", "example.com", None, "/s", None),
    ("ftp://example.com:21/s", "example.com", None, "/s", None),
    ("mailto:x@example.com", None, None, None, None),
    ("/only/a/path", None, None, None, None),
    ("", None, None, None, None),
    (None, None, None, None, None),
    ("https://example.com/a/%2e%2E", "example.com", None, "/", None),
    ("https://example-.com/x", "example-.com", None, "/x", None),
    ("https://under_score.example/x", "under_score.example", None, "/x", None),
    ("https://example.com./x", "example.com.", None, "/x", None),
    ("https://example.com/a|b", "example.com", None, "/a|b", None),
    ("https://example.com/\x7f", "example.com", None, "/%7F", None),
]


def parsed(spark, texts):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, url string").select("n", urls.parse_url(F.col("url")).alias("p"))
    return [r["p"] and (r["p"]["host"], r["p"]["port"], r["p"]["path"], r["p"]["search"]) for r in df.orderBy("n").collect()]


def test_goldens(spark):
    got = parsed(spark, [g[0] for g in GOLDEN])
    wrong = [(g, p) for g, p in zip(GOLDEN, got, strict=True) if (p or (None,) * 4) != g[1:]]
    assert not wrong


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abcXY019/.?&=%2e-:@#~'|", max_size=30), min_size=40, max_size=40))
def test_plain_pattern_agrees_with_the_whole_parser(spark, rests):
    texts = [f"{s}://{h}{r}" for r in rests for s, h in (("http", "a.example"), ("https", "example.com:8443"), ("https", "example.com:80"), ("http", "b9"))]
    df = spark.createDataFrame([(t,) for t in texts], "url string").select("url", urls.parse_url(F.col("url")).alias("a"), urls._whole(F.col("url")).alias("b"))
    assert [r for r in df.collect() if r["a"] != r["b"]] == []


@pytest.mark.parametrize("target, expected", [
    ("/a?b", "https://h.example/a?b"), ("a", "https://h.example/a"), ("?q", "https://h.example?q"), ("//other.example/x", "https://other.example/x"), ("http://o.example/y", "http://o.example/y"),
    ("\\\\o.example\\z", "https:\\\\o.example\\z"), ("", "https://h.example/"),
])
def test_resolve(spark, target, expected):
    df = spark.createDataFrame([(target,)], "t string").select(urls.resolve(F.col("t"), F.lit("https"), F.lit("h.example")).alias("u"))
    assert df.first()["u"] == expected
