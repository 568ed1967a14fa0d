"""Operator 5: license scans. Winnowed fingerprints pick candidates, banded alignment confirms them.

Texts are reduced to lower-case letters and digits. All 8-grams of characters are hashed and winnowed over windows of 8, so any
shared run of 15 such characters shares a fingerprint. Fingerprints of the templates form an inverted index (a few templates of a
few kilobytes; the size is checked before it is broadcast). Where a document's fingerprints hit it, the document's words around the
hit are aligned with the template's in a band around the hit's diagonal; matched words give coverage and span.
"""

from __future__ import annotations

import re
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mixed, read

GRAM, WINDOW = 8, 8
COVERAGE = 0.8
BAND = 8  # words by which an alignment may leave its diagonal
MAX_TEMPLATE_WORDS = 500_000
TOKEN = re.compile(r"[^\W_]+")

#: Short notices and characteristic passages of common public licenses.
TEMPLATES = [
    ("mit-notice", "Released under the MIT License."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "apache-2.0-header",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "bsd-conditions",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    (
        "mit-license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "isc-license",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

ASCII = np.zeros(128, np.uint32)  # the lower-case code point of a letter or digit, else 0
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    ASCII[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    ASCII[_c] = _c + 32


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lower-case letters and digits as code points, their positions). Anything else, such as a no-break space, is left out."""
    if text.isascii():
        a = ASCII[np.frombuffer(text.encode(), np.uint8)]
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        a = ASCII[np.minimum(points, 127)] * (points < 128)
        other = np.flatnonzero(points > 127)
        kinds, nth = np.unique(points[other], return_inverse=True)
        a[other] = np.array([ord(low) if chr(c).isalnum() and len(low := chr(c).lower()) == 1 else c * chr(c).isalnum() for c in kinds.tolist()], np.uint32)[nth]
    at = np.flatnonzero(a)
    return a[at], at


def winnowed(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and their positions: the rightmost least hash of each window. A text shorter than a window has one window."""
    n = len(a) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0xD1342543DE82EF95) + a[j : n + j]
    h = mixed(mixed(h))
    m = h
    size = 1
    while size < min(WINDOW, n):  # sliding minima by doubling
        step = min(size, min(WINDOW, n) - size)
        m = np.minimum(m[: len(m) - step], m[step:])
        size += step
    # A position is selected if its hash is the minimum of any window that holds it.
    top = np.full(n, 0, np.uint64)
    for j in range(size):
        np.maximum(top[j : j + len(m)], m, out=top[j : j + len(m)])
    at = np.flatnonzero(h == top)
    return h[at], at


def aligned(pattern: list[str], words: list[str], diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment (match 2, mismatch -1, gap -1) inside a band of word diagonals: (matched words, start, end)."""
    best, prev = (0, 0, 0, 0), {}
    for i, p in enumerate(pattern):
        row: dict[int, tuple[int, int, int]] = {}  # word position -> (score, matched, start)
        for j in range(max(0, i + diagonal - band), min(len(words), i + diagonal + band + 1)):
            same = words[j] == p
            s, m, b = prev.get(j - 1, (0, 0, j))
            cell = (s + 2, m + 1, b) if same else (s - 1, m, b)
            for s, m, b in (prev.get(j, (0, 0, 0)), row.get(j - 1, (0, 0, 0))):
                if s - 1 > cell[0]:
                    cell = (s - 1, m, b)
            if cell[0] > 0:
                row[j] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        prev = row
    return best[1:]


class Templates:
    """Templates with their words, and the inverted index of their fingerprints."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        self.words = [TOKEN.findall(t.lower()) for _, t in templates]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(templates):
            ends = np.cumsum([len(w.encode()) for w in self.words[k]])
            for h, at in zip(*winnowed(plain(text)[0]), strict=True):
                self.index.setdefault(int(h), []).append((k, int(np.searchsorted(ends, at, "right"))))
        self.hashes = np.array(sorted(self.index), np.uint64)
        self.some = np.zeros(1 << 16, bool)
        self.some[self.hashes >> np.uint64(48)] = True


def matches(text: str | None, t: Templates, coverage: float, band: int) -> list[dict]:
    """Matches of templates in a whole text, by position. Spans are code points, ends exclusive."""
    if not text:
        return []
    letters, place = plain(text)
    h, at = winnowed(letters)
    some = t.some[h >> np.uint64(48)]
    h, at = h[some], at[some]
    hit = np.isin(h, t.hashes)
    if not hit.any():
        return []
    words = [(m.group().lower(), m.start(), m.end()) for m in TOKEN.finditer(text)]
    only = [w for w, _, _ in words]
    starts = np.array([s for _, s, _ in words])
    seeds: dict[int, set[int]] = {}
    for v, j in zip(h[hit], np.searchsorted(starts, place[at[hit]], "right") - 1, strict=True):
        for k, i in t.index[int(v)]:
            seeds.setdefault(k, set()).add(int(j) - i)
    out = []
    for k, diagonals in sorted(seeds.items()):
        pattern, taken = t.words[k], -(1 << 60)
        near = min(band, max(1, len(pattern) // 2))  # below the distance at which a short template can follow itself
        group: list[int] = []
        for d in [*sorted(diagonals), 1 << 60]:
            if group and d - group[-1] > near:  # seeds of one occurrence lie on neighbouring diagonals
                middle, wide = (group[0] + group[-1]) // 2, near + group[-1] - group[0]
                first = max(0, middle - wide)  # all words that the band can reach, or an end within it would be cut off
                part = only[first : max(0, middle + wide + len(pattern))]
                m, s, e = aligned(pattern, part, middle - first, wide)
                s, e = s + first, e + first
                if m / len(pattern) >= coverage and s >= taken:
                    out.append({"license": t.names[k], "coverage": m / len(pattern), "matched": m, "start": words[s][1], "end": words[e - 1][2]})
                    taken = e
                group = []
            group.append(d)
    return sorted(out, key=lambda r: (r["start"], r["license"]))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE, band: int = BAND) -> DataFrame:
    """One row for each template match in the texts of docs (doc_id, text): doc_id, license, coverage, matched, start, end.

    coverage is the share of the template's words that the alignment matches, start and end are code points of the text. Null and
    empty texts have no rows, texts of any length are scanned whole, a null doc_id is passed on. Repeated occurrences and repeated rows
    are reported each; where one passage fits several templates each has a row, and of equally good alignments of one template the one
    that ends first counts. An empty table gives no rows; further columns are not read. Templates of fewer than GRAM letters and
    digits have no fingerprint and are refused, as are more than MAX_TEMPLATE_WORDS words in all.
    """
    index = Templates(templates)
    if any(len(plain(t)[0]) < GRAM for _, t in templates) or sum(map(len, index.words)) > MAX_TEMPLATE_WORDS:
        raise ValueError("a template is too short, or there are too many to broadcast")
    sent = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("array<struct<license:string,coverage:double,matched:int,start:int,end:int>>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([matches(t, sent.value, coverage, band) for t in texts], dtype=object)

    return docs.select("doc_id", found.asNondeterministic()(F.col("text")).alias("__found")).select("doc_id", F.inline("__found"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
