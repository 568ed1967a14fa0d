"""Operators whose tasks use numpy, against brute force, held-out accuracy and edge cases."""

import math

import numpy as np
import pytest

import corpus_pipeline
from traffic_signals.llm import decontaminate, language_id, licenses, line_quality, near_duplicates, neighbours, toxicity
from traffic_signals.llm.boosting import calibrated, isotonic
from traffic_signals.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MESSY = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\n ", None, "a", 3), (3, "word", "en", None, None), (3, "word", "en", None, None), (4, "x" * 100_000, "fr", "b", 1), (5, "a b\n" * 20_000, "en", "b", 1), (6, "123 !!", "de", "b", 1)]


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(MESSY, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("score", "kept", "label", "held_out", "root", "id", "coverage", "license")})


@pytest.fixture(scope="session")
def labels(spark, data):
    return spark.read.parquet(f"{data}/labels.parquet")


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    got = dict(components(spark.createDataFrame(pairs, "u long, v long")).collect())
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_components(rows, k, percent=80):
    sets, up = [], {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(rows[a][0]), find(rows[b][0])
                up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True)}


def test_near_duplicates_match_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    monkeypatch.setattr(near_duplicates, "SET_BYTES", 20_000)
    monkeypatch.setattr(near_duplicates, "ROWS_PER_BIN", 50)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    chain, rows = list(rng.choice(words, 60)), []
    for i in range(60):  # a drifting chain: neighbours are linked, ends are not
        chain[int(rng.integers(60))] = f"n{i}"
        rows.append((10_000 + i, " ".join(chain)))
    rows += [(20_000, rows[3][1].upper()), (20_001, None), (20_002, ""), (20_003, "two words"), (20_004, "TWO\twords"), (20_005, "two"), (20_006, "  ")]
    rows += docs.select("doc_id", "text").limit(150).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()}
    assert got == brute_components([tuple(r) for r in rows], 4)


def test_near_duplicate_edges(spark, messy):
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in near_duplicates.near_duplicates(messy).collect())
    assert len(got) == len(MESSY) and all(kept for *_, kept in got) and ("None", 0, "None", True) in got
    out = near_duplicates.drop_near_duplicates(messy)
    assert out.columns == messy.columns and out.count() == len(MESSY) - 1  # a repeated row goes
    assert near_duplicates.near_duplicates(messy.limit(0)).count() == 0 and near_duplicates.drop_near_duplicates(messy.limit(0)).count() == 0


def test_texts_that_share_an_id(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(3, " ".join(a)), (3, " ".join(b)), (1, near(a)), (6, near(b)), (3, " ".join(b))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(df).collect())
    assert got == [(1, 1, True), (3, 1, False), (3, 3, True), (3, 3, True), (6, 3, False)]
    assert sorted(map(tuple, near_duplicates.drop_near_duplicates(df).collect())) == [(1, near(a)), (3, " ".join(b))]


def test_texts_that_are_alike_but_not_linked(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    common = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join([*common, *(f"u{i}x{j}" for j in range(28 + i % 3))])) for i in range(40)] + [(100, " ".join([*common, *(f"u5x{j}" for j in range(26))]))]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows, 4) and got[100][1] == 5 and len({c for _, c in got.values()}) == 40


def plain_tiles(a, b, least):
    ma, mb, out = [0] * len(a), [0] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                best = (n, i, j) if n > best[0] else best
        n, i, j = best
        if n < least:
            return out
        ma[i : i + n] = mb[j : j + n] = [1] * n
        out.append((i, j, n))


def test_tiles_match_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(400):
        a = rng.integers(0, rng.choice([2, 3, 30]), rng.integers(1, 26)).tolist()
        b = rng.integers(0, 30, rng.integers(0, 12)).tolist()
        for _ in range(3):
            i, at = int(rng.integers(len(a))), int(rng.integers(len(b) + 1))
            b[at:at] = a[i : i + int(rng.integers(1, 15))]
        for least in (1, 2, 4):
            assert decontaminate.tiles(a, b, least) == plain_tiles(a, b, least)


def test_contaminations_match_brute_force():
    rng = np.random.default_rng(5)
    items = [(k, rng.integers(0, 60, rng.integers(1, 30)).astype(np.uint64) * np.uint64(8)) for k in range(40)]
    index = decontaminate.Index(items, 3)
    for _ in range(60):
        h = np.concatenate([x[1][int(a) : int(a) + 12] for x, a in ((items[k], rng.integers(0, 9)) for k in rng.integers(0, 40, 6))])
        got = {r["item_id"]: (r["coverage"], r["tiles"]) for r in decontaminate.contaminations(h, index, 3, 0.5)}
        want = {}
        for k, pattern in items:
            found = plain_tiles(pattern.tolist(), h.tolist(), min(3, len(pattern)))
            share = sum(n for *_, n in found) / len(pattern)
            if len(pattern) < 3:
                if found and found[0][2] == len(pattern):
                    want[k] = (1.0, 1)
            elif share >= 0.5:
                want[k] = (share, len(found))
        assert got == want


def test_tiles():
    assert decontaminate.tiles([1, 2, 3, 4, 5, 6], [4, 5, 6, 9, 1, 2, 3], 2) == [(0, 4, 3), (3, 0, 3)]
    assert decontaminate.tiles([1, 1, 1, 1], [1, 1, 1], 2) == [(0, 0, 3)]
    assert decontaminate.tiles(list(range(50)), list(range(50)), 5) == [(0, 0, 50)]
    assert decontaminate.tiles([], [1], 2) == []


def test_decontamination(spark, messy):
    item = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (None, "a b c d e f g"), (4, " ".join(f"z{i}" for i in range(12))), (5, "--")], "item_id long, text string")
    swapped = [*item[20:], "gap", *item[:10], "more", *item[10:20]]
    rows = [(1, "x " + " ".join(item).upper() + " y"), (2, " ".join(swapped)), (3, " ".join(item[:12])), (4, None), (5, "far too short"), (6, "pad " * 50_000 + " ".join(item)), (7, "short too")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1_000_000, 20):
        got = {(r["doc_id"], r["item_id"]): (r["coverage"], r["tiles"]) for r in decontaminate.find_leaks(df, bench, block_words=block).collect()}
        assert got == {(1, 1): (1.0, 1), (2, 1): (1.0, 3), (5, 2): (1.0, 1), (6, 1): (1.0, 1)}
        assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(df, bench, block_words=block).collect()) == [3, 4, 7]
    assert decontaminate.drop_leaks(messy, bench.limit(0)).columns == messy.columns
    assert decontaminate.drop_leaks(messy, bench).count() == len(MESSY) and decontaminate.find_leaks(messy.limit(0), bench).count() == 0


def test_language_id(spark, docs, messy):
    model = language_id.fit(docs)
    out = language_id.predict(docs, *model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.95
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(messy, *model).collect()}
    assert [got[k] for k in (None, 1, 2, 6)] == ["und"] * 4 and got[3] != "und"
    nothing = language_id.predict(messy, *language_id.fit(messy.limit(0)))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    # As many languages as documents.
    langs, logs = language_id.fit(docs.withColumn("lang", docs["doc_id"].cast("string")))
    assert len(langs) > 100 and logs.size <= language_id.MATRIX_CELLS + len(langs)


def test_language_scores_match_brute_force(monkeypatch):
    texts = ["abcabc", "x", "Ünder", "", "words of a longer text " * 20]
    logs = np.random.default_rng(6).normal(size=(65, 3))
    want = []
    for t in texts:
        points, total = [ord(c) for c in f" {t.lower()} "], logs[-1].copy()
        for n in language_id.ORDERS:
            for i in range(len(points) - n + 1):
                h = np.array([n], np.uint64)
                for c in points[i : i + n]:
                    h = h * np.uint64(0x100000001B3) + np.uint64(c)
                total += logs[int(language_id.mixed(h)[0] % np.uint64(64))]
        want.append(total)
    for chunk in (1 << 17, 7):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        assert np.allclose(language_id.log_scores(texts, logs), want)


def test_line_quality(spark, docs, labels, messy):
    model = line_quality.fit(docs, labels)
    out = line_quality.score(docs, model).join(labels, "doc_id").toPandas()
    assert out["score"].between(0, 1).all() and (out["predicted"] == out["quality"]).mean() > 0.93
    got = line_quality.score(messy, model).collect()
    assert len(got) == len(MESSY) and all(0 <= r["score"] <= 1 for r in got)
    assert line_quality.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in line_quality.score(messy, None).collect()} == {0.5}
    assert line_quality.keep_good(messy, labels).columns == messy.columns


def test_line_features_match_brute_force():
    text = "The Cat sat 12 !!\nGO GO GO\n\na a b é"
    x, w = line_quality.line_features(text)
    want = []
    for line in text.split("\n"):
        b, words = line.encode(), line.split()
        n = max(1, len(b))
        symbol = sum(not (c >= 128 or chr(c).isalnum() or chr(c) in " .,;:'\"()-") for c in b) / n
        loud = [sum(c.isupper() for c in v) >= 2 and sum(c.islower() for c in v) == 0 for v in words]
        want.append([sum(65 <= c <= 90 for c in b) / n, sum(48 <= c <= 57 for c in b) / n, sum(chr(c) in ".,;:'\"()-" for c in b) / n, symbol, min(symbol * 10, 1),
                     sum(p == q for p, q in zip(words, words[1:])) / max(1, len(words)), sum(loud) / max(1, len(words)), math.log1p(len(b)) / 8, len(b) == 0])
    assert np.allclose(x[:, :9], want, atol=1e-6) and np.allclose(x[1:, 9:16], x[:-1, :7]) and np.allclose(x[:-1, 16:23], x[1:, :7])
    assert w.tolist() == [len(s.encode()) or 1 for s in text.split("\n")]


def test_the_fit_reads_whole_texts(spark):
    # What tells the labels apart stands behind 300 like lines.
    rows = [(i, "one plain line\n" * 300 + ("bad ***\n" if i % 2 else "good words\n") * 300) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in line_quality.score(df, line_quality.fit(df, marks)).collect()}
    assert min(s for i, s in got.items() if i % 2 == 0) > max(s for i, s in got.items() if i % 2)


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    node, pair = rng.normal(size=(1, 5)), rng.normal(size=(2, 2))
    good, _, log_z = line_quality.marginals(node, np.array([5]), pair)
    z, on = 0.0, np.zeros(5)
    for code in range(32):
        y = [(code >> i) & 1 for i in range(5)]
        w = math.exp(sum(node[0, i] * y[i] for i in range(5)) + sum(pair[y[i - 1], y[i]] for i in range(1, 5)))
        z += w
        on += w * np.array(y)
    assert np.allclose(good[0], on / z) and np.isclose(log_z[0], math.log(z))


def test_toxicity(spark, data, messy):
    big = data.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").toPandas()
    assert (out["predicted"] == out["toxic"]).mean() > 0.93 and out["score"].between(0, 1).all()
    assert len(toxicity.score(messy, model).collect()) == len(MESSY)
    assert toxicity.fit(docs, labels.limit(0)) is None and {r["score"] for r in toxicity.score(messy, None).collect()} == {0.0}


def test_toxicity_features():
    lexicon = {"idiot": 3.0, "stupi~": 2.0}
    names = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! so stupidly b4d, and ² Ⅷ far away from it all idiot", lexicon), strict=True))
    words = ["You", "IDIOT", "so", "stupidly", "b4d", "and", "²", "Ⅷ", "far", "away", "from", "it", "all", "idiot"]
    n, letters = len(words), sum(c.isalpha() for w in words for c in w)
    assert names["density"] == 3 / n and names["weighted"] == 8 / n and names["strongest"] == 3 and names["distinct"] == 2 and names["second_person"] == 1 / n and names["near"] == 2 / n
    assert names["capitals"] == 6 / letters and names["shouted"] == 1 / n and names["obfuscated"] == 1 / n
    # A feature that is a share does not change with the length of a text.
    part = "Aa ½² B3 ok "
    short, long = (toxicity.features(part * k, lexicon) for k in (300, 3000))
    assert np.allclose(short[:3] + short[5:11], long[:3] + long[5:11])
    assert toxicity.features(None, lexicon) == toxicity.features("  ", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_toxicity_without_rows(spark, messy):
    assert toxicity.score(messy.limit(0), None).count() == 0 and line_quality.score(messy.limit(0), None).count() == 0


def test_isotonic():
    knots = isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    p = calibrated(knots, np.linspace(0, 5, 50))
    assert (np.diff(p) >= 0).all() and 0 <= p[0] <= p[-1] <= 1


def test_licenses(spark, messy):
    text = dict(licenses.TEMPLATES)
    grant = text["mit-grant"].replace("free of charge", "free of any charge").replace("\"Software\"", "Software")
    rows = [(1, "é intro\n" + text["mit-notice"] + " tail"), (2, grant.upper()), (3, "licensed things"), (4, None), (5, (text["mit-notice"] + " ") * 3), (6, "word " * 50_000 + text["apache-2.0-notice"])]
    got = [(r["doc_id"], r["license"], r["start"], r["end"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert (1, "mit-notice", 8, 8 + len(text["mit-notice"]) - 1) in got
    assert sorted((d, n) for d, n, *_ in got) == [(1, "mit-notice"), (2, "mit-grant"), (5, "mit-notice"), (5, "mit-notice"), (5, "mit-notice"), (6, "apache-2.0-notice")]
    assert licenses.scan(messy).count() == 0 and licenses.scan(messy.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(messy, [("short", "a b")])


def brute_licenses(text, templates, coverage):
    """Templates that somewhere share enough words with a text, by alignment with all of it."""
    words, out = [w.lower() for w in licenses.TOKEN.findall(text)], set()
    for name, template in templates:
        pattern = [w.lower() for w in licenses.TOKEN.findall(template)]
        m, *_ = licenses.aligned(pattern, words, 0, len(words) + len(pattern))
        if m / len(pattern) >= coverage:
            out.add(name)
    return out


def test_licenses_match_full_alignment(spark):
    rng, rows = np.random.default_rng(7), []
    for i in range(60):
        name, template = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = template.split()
        for _ in range(int(rng.integers(0, 1 + len(words) // 8))):
            words[int(rng.integers(len(words)))] = "changed"
        filler = [" ".join(rng.choice(["some", "other", "words", "é", "of", "the"], 40)) for _ in range(2)]
        rows.append((i, filler[0] + "\u00a0" + ["\u00a0", " ", "\n * "][i % 3].join(words) + " " + filler[1]))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
    assert got == {i: want for i, t in rows if (want := brute_licenses(t, licenses.TEMPLATES, licenses.COVERAGE))}


def brute_neighbours(rows, every=20, nearest=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [k for k in np.lexsort((ids, -s)) if k != i][:nearest]
        out[int(ids[i])] = [(int(ids[k]), s[k]) for k in order]
    return out


def test_neighbours(spark, data, monkeypatch):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    want = brute_neighbours([(r["vec_id"], r["embedding"]) for r in df.collect()])
    monkeypatch.setattr(neighbours, "SHARD", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 10)
    got = {}
    for r in neighbours.search(df, centroids=6).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9
    exact = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect()}
    assert all(s == math.fsum(exact[q] * exact[v]) for q in got for v, s in got[q])


@pytest.mark.parametrize("clusters", [40, 0])
def test_neighbours_beyond_the_sample(spark, clusters):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 16))
    if clusters:
        x = rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 4000)] + 0.15 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute_neighbours(rows)
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=800, centroids=16).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9
    if clusters:  # an index of clustered vectors visits few of them
        index = neighbours.MultiIndex(x[:800], 16)
        counts = np.bincount(index.cell(x), minlength=256)
        assert np.mean([counts[c].sum() for c in index.walks(x[:200], counts)]) < 0.35 * len(x)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, v string")
    got = [tuple(r) for r in neighbours.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 20, 1.0), (0, 3, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 2, 1.0), (20, 3, 1, 0.5)]
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.25])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in neighbours.search(twice).collect()) == [(0, 1, 1, 0.25), (0, 1, 1, 0.5), (0, 2, 0, 0.0), (0, 2, 0, 0.0)]
    same = spark.createDataFrame([(i, [0.6, 0.8]) for i in range(60)], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in neighbours.search(same).where("query_id = 20").orderBy("rank").collect()] == [*range(20)]
    assert neighbours.search(df.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept, seen = docs, []
    from traffic_signals.llm.common import staged

    for name, stage in corpus_pipeline.STAGES:
        kept = staged(stage(spark, kept, data), f"test-{name}")
        seen.append(kept.count())
        assert name == "mixture" or kept.columns == docs.columns
    assert docs.count() > seen[0] > seen[1] >= seen[2] == seen[3] >= seen[4] > 0
    assert kept.where("text rlike '[a-z0-9]@mail'").count() == 0
    assert seen[1] == sum(r["kept"] for r in near_duplicates.near_duplicates(corpus_pipeline.quality(spark, docs, data)).collect())
    rerun = corpus_pipeline.run(spark, data)
    assert rerun.exceptAll(kept).count() == 0 == kept.exceptAll(rerun).count()


def test_pipeline_stages_on_messy_rows(spark, messy, data):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, messy.limit(0), data).count() == 0
        out = stage(spark, messy, data)
        assert set(messy.columns) <= set(out.columns) and out.count() <= len(MESSY), name


def test_a_cluster_needs_a_shared_folder():
    from traffic_signals.llm.common import shared_dir

    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        shared_dir(Session)
