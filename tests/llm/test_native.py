"""Operators written in DataFrame expressions: URL rules, mixing, personal data."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import oracle, spark_rows
from traffic_signals.llm import mixing, personal_data, registry, url_rules


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, data, name):
    assert spark_rows(registry.QUERIES[name](spark, data)) == oracle(registry.ORACLES[name], data)


URLS = [
    (1, "https://a.Example.com/en/x", "a.example.com", "/en/x", "example.com/en/", "block"),
    (2, "http://WWW.example.com/en/?q", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    (3, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    (4, "http://x.net/es/a#b", "x.net", "/es/a", "net/es/", "block"),
    (5, "http://x.net/es", "x.net", "/es", None, "allow"),
    (6, "http://x.com", "x.com", "", None, "allow"),
    (7, "no scheme", "", "", None, "allow"),
    (8, None, "", "", None, "allow"),
    (None, "http://fr.x.net/fr//a", "fr.x.net", "/fr//a", "net/fr/", "block"),
    (9, "http://" + "a." * 3000 + "net/es/" + "d/" * 3000, "a." * 3000 + "net", "/es/" + "d/" * 3000, "net/es/", "block"),
    (9, "http://x.net/es/a", "x.net", "/es/a", "net/es/", "block"),
    (9, "http://x.net/es/a", "x.net", "/es/a", "net/es/", "block"),
]


@pytest.mark.parametrize("most", [100_000, 0])
def test_urls(spark, most):
    df = spark.createDataFrame([(*u[:2], "x", "y", "z") for u in URLS], "page_id long, url string, host string, rule string, html string")
    rules = url_rules.rule_table(spark, url_rules.RULES)
    key = lambda t: tuple(map(str, t))
    got = url_rules.apply_rules(df, rules, broadcast_rules=most, salts=3)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(key, got.collect())) == sorted(key((u[0], *u[2:])) for u in URLS)
    assert url_rules.apply_rules(df, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == len(URLS)
    assert url_rules.apply_rules(df.limit(0), rules).count() == 0


def test_rule_paths_inside_a_directory(spark):
    rules = url_rules.rule_table(spark, [("block", "x.com", "/ab"), ("allow", "x.com", "/abc/"), ("block", "", "/"), ("block", "y.com", "")])
    df = spark.createDataFrame([(1, "http://x.com/abd"), (2, "http://q.x.com/abc/d"), (3, "http://x.com/a"), (4, "http://y.com")], "page_id long, url string")
    assert [tuple(r)[3:] for r in url_rules.apply_rules(df, rules).orderBy("page_id").collect()] == [("x.com/ab", "block"), ("x.com/abc/", "allow"), (None, "allow"), ("y.com", "block")]


def brute_targets(sizes):
    left, out, live = sum(sizes.values()), {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    while live:
        level = left / sum(live.values())
        full = [s for s in live if 3 * sizes[s] <= level * live[s]]
        if not full:
            return out | {s: live[s] * level for s in live}
        for s in full:
            out[s] = 3 * sizes[s]
            left -= out[s]
            del live[s]
    return out


def test_mixing_edges(spark):
    rows = [(i, " ".join(["w"] * (i % 40)), f"s{i % 5}" if i % 50 else None, 1, 2) for i in range(600)] + [(None, "a b", "s1", 1, 2), (7, None, "s2", 1, 2), (8, "a b", "s2", 1, 2), (8, "a b", "s2", 1, 2), (9, "word " * 50_000, "s0", 1, 2), (10, "", "empty", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key int, target int")
    for per in (3, 2000):
        got = mixing.mix(df, per_bucket=per).collect()
        assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
        sizes = {}
        for r in got:
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        want = brute_targets({s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s))})
        for s in sizes:
            own = [r for r in got if r["source"] == s]
            assert {r["source_size"] for r in own} == {sizes[s]} and abs(own[0]["target"] - want[s]) < 1e-6
            assert abs(sum(r["taken"] for r in own) - want[s]) < 1
    again = {(r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(df).collect()}
    assert again == {(r["doc_id"], r["size"], r["taken"]) for r in got}
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mixed_documents(df).columns == ["doc_id", "text", "source", "key", "size", "source_size", "target", "taken"]


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 10 <= len(d) <= 15
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 14 <= len(d) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
    return True


def brute_digest(text):
    spans = sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(k, m.group()))
    return hashlib.sha256(",".join(f"{PATTERNS[i][0]}:{a}:{b}" for a, i, b in spans).encode()).hexdigest()


TEXTS = [
    None, "", "a@b.c_d@e.f g@h", "x..y@z.co.uk.", "@a.b a@.b a@b", "ñ 1.2.3.4.5.6.7.8 é 256.1.1.1 01.002.0003.4", "card 4111 1111 1111 1111, 4111-1111-1111-1112", "4111111111111111 4111  1111",
    "+1 (555) 123-4567. +1 2 +123456789012345678 ++1 555 555 5555", "tel +4111111111111111 😀 a+b@c.de", "1" * 70_000, "a" * 70_000 + "@", "x@y.z " * 3000, "1.1.1.1 " * 300, "-".join("1234567890" * 300),
]


def test_base_spans_match_brute_force(spark, data):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string, key int")
    got = {r["doc_id"]: r["base_sha256"] for r in personal_data.report(df).collect()}
    assert got == {i: brute_digest(t) for i, t in enumerate(TEXTS)}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    assert {r["doc_id"]: r["base_sha256"] for r in personal_data.report(docs).collect()} == {i: brute_digest(t) for i, t in texts.items()}
    assert personal_data.report(df.limit(0)).count() == 0


def test_disclosing_words(spark):
    secret = [(i, f"note {i} zebrafish wrote to ann@corp.example about item {i} today", 1) for i in range(6)]
    plain = [(i, f"note {i} about a common item today number {i}", 1) for i in range(100, 160)]
    df = spark.createDataFrame([*secret, *plain, (None, None, 1), (1, secret[1][1], 1)], "doc_id long, text string, term int")
    rows = {r["doc_id"]: r["spans"] for r in personal_data.report(df).collect()}
    assert all("term:7:16" in rows[i] and rows[i].count("term") <= 2 for i in range(6)) and not any(rows[i] for i in range(100, 160))
    out = {r["doc_id"]: r["text"] for r in personal_data.sanitise(df).collect()}
    assert "zebrafish" not in out[0] and "[EMAIL]" in out[0] and out[100] == plain[0][1] and out[None] is None
    assert personal_data.sanitise(df).columns == df.columns and personal_data.sanitise(df).count() == len(out) + 1


def test_disclosing_words_far_from_the_mention(spark):
    filler = "some common words stand here " * 20
    secret = [(i, f"Zebrafish {i} {filler} ann@corp.example {filler}{i} again zebrafish") for i in range(8)]
    plain = [(i, f"note {i} {filler} again") for i in range(100, 160)]
    elsewhere = [(200, "mail bob@other.example, not about it")]
    df = spark.createDataFrame([*secret, *plain, *elsewhere], "doc_id long, text string")
    rows = {r["doc_id"]: r["spans"] for r in personal_data.report(df).collect()}
    assert all(rows[i].count("term") == 2 and rows[i].startswith("term:0:9") for i in range(8)) and "term" not in rows[200]
    out = dict(personal_data.sanitise(df).collect())
    assert not any("zebrafish" in out[i].lower() for i in range(8)) and out[0].count("common") == 40
    # A name that also stands in mentions counts where it stands alone.
    own = [(i, f"corp {i} {filler} ann@corp.example") for i in range(8)]
    assert all("term:0:4" in r["spans"] for r in personal_data.report(spark.createDataFrame([*own, *plain], "doc_id long, text string")).collect() if r["doc_id"] < 100)


def test_disclosing_words_of_groups(spark):
    secret = [(i, f"zebrafish {i} wrote unique{chr(97 + i)}word to m{i}@corp.example today") for i in range(8)]
    numbers = [(20 + i, f"quokka {i} called from +1 (555) 123-450{i} today and 10.20.{i}.7 okapi") for i in range(8)]
    plain = [(i, f"note {i} wrote and called to and from today") for i in range(100, 160)]
    df = spark.createDataFrame([*secret, *numbers, *plain], "doc_id long, text string")
    out = dict(personal_data.sanitise(df).collect())
    assert not any("zebrafish" in out[i] or "quokka" in out[20 + i] or "okapi" in out[20 + i] for i in range(8))
    # One text proves nothing, and what stands everywhere stays.
    assert all(f"unique{chr(97 + i)}" in out[i] and "wrote" in out[i] and "today" in out[20 + i] for i in range(8)) and all(out[i] == t for i, t in plain)


def brute_terms(rows, prior=personal_data.PRIOR, generalise=personal_data.GENERALISE):
    """Words that disclose an entity of their document, by the formula of the module, from counts over all documents."""
    docs = []
    for i, text in rows:
        blank, found = text, set()
        for kind, (_, p) in enumerate(PATTERNS):
            for m in re.finditer(p, text):
                if valid(PATTERNS[kind][0], m.group()):
                    blank = blank[: m.start()] + "\n" * (m.end() - m.start()) + blank[m.end() :]
                    low, d = m.group().lower(), re.sub("[^0-9]", "", m.group())
                    name = re.match(r"[^@a-z]*([a-z]+)[^@]*@", low)
                    groups = [[low, "*@" + low.split("@")[-1], *([name.group(1) + "*@"] if name else [])], [low, ".".join(low.split(".")[:3]) + ".*", ".".join(low.split(".")[:2]) + ".*"], [d, d[:6] + "*"], [d, d[:4] + "*"]]
                    found |= {(kind, e) for e in groups[kind]}
        docs.append((i, text, found, {w.lower() for w in re.findall(r"[^\W\d_]{3,}", blank)}))
    n = len(docs)
    out = {}
    for i, _, entities, words in docs:
        for t in words:
            for e in entities:
                n_e, n_t, both = (sum(f(d) for d in docs) for f in (lambda d, e=e: e in d[2], lambda d, t=t: t in d[3], lambda d, e=e, t=t: e in d[2] and t in d[3]))
                if n_e == n:
                    continue
                texts = len({d[1] for d in docs if e in d[2] and t in d[3]})
                score = texts / (texts + prior) * (1 + math.log(both / n_t) / -math.log(n_e / n))
                if score >= generalise:
                    out.setdefault(i, set()).add(t)
    return out


def test_terms_match_brute_force(spark):
    rng = np.random.default_rng(3)
    names = ["ann@corp.example", "bob.x@corp.example", "eve@other.example", "10.1.2.3", "+1 555 123 4567"]
    own = {e: [f"{a}{'pqrst'[k]}{b}" for a in ("kiwi", "lemon") for b in "xyz"[: k + 1]] for k, e in enumerate(names)}
    rows = []
    for i in range(240):
        text = [str(w) for w in rng.choice(["common", "words", "about", "things"], 6)]
        if i < 60:
            e = names[i % 5]
            text += [e, *(w for w in own[e] if rng.random() < 0.8)]
        elif rng.random() < 0.02:
            text += ["kiwix"]
        rows.append((i, " ".join(str(w) for w in rng.permutation(text)) if i % 11 else " ".join(text)))
    got = {}
    for r in personal_data.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for kind, a, b in (x.split(":") for x in r["spans"].split(",") if x):
            if kind == "term":
                got.setdefault(r["doc_id"], set()).add(rows[r["doc_id"]][1][int(a) : int(b)].lower())
    assert got == brute_terms(rows) and got


def test_generalised_words(spark):
    """A word between the thresholds keeps as much of its beginning as frequent words share."""
    secret = [(i, f"note {i} zebrafish wrote to ann@corp.example today") for i in range(5)]
    plain = [(i, f"note {i} about a zebra today") for i in range(100, 160)]
    out = dict(personal_data.sanitise(spark.createDataFrame([*secret, *plain], "doc_id long, text string"), remove=0.95).collect())
    assert all(out[i] == f"note {i} [zebra*] wrote to [EMAIL] today" or "[zebra*]" in out[i] for i in range(5)) and out[100] == plain[0][1]


def test_very_many_mentions(spark):
    text = " ".join(f"user{i} wrote a{i}@mail{i % 50}.example" for i in range(20_000))
    df = spark.createDataFrame([(k, text + f" {k}") for k in range(4)] + [(9, "é" * 300_000)], "doc_id long, text string")
    assert [r["n_email"] for r in personal_data.report(df).orderBy("doc_id").collect()] == [20_000] * 4 + [0]
    out = dict(personal_data.sanitise(df).collect())
    assert out[0].count("[EMAIL]") == 20_000 and "@" not in out[0] and out[9] == "é" * 300_000


def test_weights_of_the_mix_follow_quality(spark, data):
    big = data.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{big}/documents.parquet").join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").withColumn("words", mixing.words_of(F.col("text")))
    w = docs.select("quality", mixing.quality_weight(F.col("text"), F.size("words"), F.size(F.array_distinct("words"))).alias("w")).toPandas().groupby("quality")["w"]
    assert w.median()[1] > 3 * w.median()[0] and w.min().min() >= 0.05 and w.max().max() <= 1.05 + 1e-9


def test_urls_without_a_host_skip_the_join(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "no scheme") for i in range(50)] + [(50, "http://x.net/es/")], "page_id long, url string")
    got = url_rules.apply_rules(df, url_rules.rule_table(spark, url_rules.RULES)).where("rule is null").collect()
    assert len(got) == 50 and {tuple(r)[1:] for r in got} == {("", "", None, "allow")}


def test_no_python_on_the_native_path(spark, data):
    for name in ("op2_mix_sources", "op8_personal_data", "op10_url_filter"):
        plan = registry.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
