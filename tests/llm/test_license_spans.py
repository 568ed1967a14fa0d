"""Spans, coverage and number of license notices: against planted places, and against a whole alignment written apart."""

import numpy as np

from traffic_signals.llm import licenses


def planted():
    """(doc_id, text, expected rows): notices between filler, some of their inner words changed, several to a text."""
    rng, rows = np.random.default_rng(11), []
    for i in range(40):
        text, want = "é filler words that belong to no license ", []
        for _ in range(1 + i % 3):
            name, template = licenses.TEMPLATES[int(rng.integers(len(licenses.TEMPLATES)))]
            words = template.split()
            tokens = [len(licenses.TOKEN.findall(w)) for w in words]
            inner = [k for k in range(4, len(words) - 4, 9) if tokens[k] == 1]
            changed = rng.choice(inner, int(rng.integers(0, 1 + len(inner) // 2)), replace=False).tolist() if inner else []
            for k in changed:
                words[k] = "zzchanged"
            piece = " ".join(words)
            found = list(licenses.TOKEN.finditer(piece))
            want.append((name, len(text) + found[0].start(), len(text) + found[-1].end(), sum(tokens) - len(changed), sum(tokens)))
            text += piece + " " + " ".join(rng.choice(["qqa", "qqb", "qqc"], 30)) + " "
        rows.append((i, text, want))
    return rows


def whole_alignment(pattern, words):
    """(score, matched) of the best local alignment of all of a pattern with all of a text; match 2, mismatch and gap -1."""
    score, matched = np.zeros((len(pattern) + 1, len(words) + 1), int), np.zeros((len(pattern) + 1, len(words) + 1), int)
    for i, p in enumerate(pattern, 1):
        for j, w in enumerate(words, 1):
            same = p == w
            options = [(score[i - 1, j - 1] + (2 if same else -1), matched[i - 1, j - 1] + same), (score[i - 1, j] - 1, matched[i - 1, j]), (score[i, j - 1] - 1, matched[i, j - 1]), (0, 0)]
            score[i, j], matched[i, j] = max(options, key=lambda o: o[0])
    best = np.unravel_index(score.argmax(), score.shape)
    return int(score[best]), int(matched[best])


def test_planted_notices(spark):
    rows, got = planted(), {}
    for r in licenses.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["start"], r["end"], r["matched"], r["coverage"]))
    for i, text, want in rows:
        for name, start, end, matched, size in want:
            assert (name, start, end, matched, matched / size) in got[i], (name, text[start:end][:60])
        spans = sorted((s, e) for _, s, e, *_ in want)
        assert all(any(a <= s and e <= b for a, b in spans) for _, s, e, *_ in got[i])  # nothing is found in filler


def test_matched_words_agree_with_a_whole_alignment(spark):
    rows = planted()[:6]
    for i, text, want in rows:
        words = [w.lower() for w in licenses.TOKEN.findall(text)]
        for name, *_ in want:
            pattern = [w.lower() for w in licenses.TOKEN.findall(dict(licenses.TEMPLATES)[name])]
            found = [m for m in licenses.matches(text, licenses.Templates([(name, dict(licenses.TEMPLATES)[name])]), licenses.COVERAGE, licenses.BAND)]
            assert max(m["matched"] for m in found) == whole_alignment(pattern, words)[1]
