"""License scan by winnowed fingerprints and banded alignment (operator 7).

The word 3-grams of every template are winnowed (the smallest hash of every four
neighbours is kept) into an inverted index hash -> (template, place).  All 3-grams
of a text are looked up, so any six words in a row that a text shares with a
template hit the index, and a template shorter than that does so when it stands
there whole.  Hits of one template on neighbouring diagonals are one candidate,
and the words around it are aligned to the template (local alignment within a
band of ``BAND`` words either side of the diagonal: equal words +1, other words
and gaps -1); what lies before and behind the best alignment is aligned again while
it holds a hit, so copies closer than the band are found one by one.  Aligned regions that follow one another in the template and, at most
a template's length apart, in the text are chained, so a notice with words inserted
or left out is one finding, whatever their number; where two regions overlap, the
shared words count once.  Reported: the share of the template's words matched (coverage),
and the span in the text, in code points.

Scale: one pass over whole texts, no shuffle; the index is the only thing sent
to tasks, and templates of more than ``MAX_WORDS`` words in all are refused.

Edge cases: null or wordless texts have no rows; a template may be found several
times in a text, each with its own span; spans of different templates may
overlap; repeated rows repeat their findings; templates of fewer than three words
are refused.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import chunks, grams, words

GRAM = 3
WINDOW = 4
BAND = 8
COVERAGE = 0.6
MAX_WORDS = 1_000_000

#: fixed values: public license notices
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
}


def winnow(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places kept: the rightmost smallest hash of every ``window`` neighbours."""
    if len(h) <= window:
        return np.asarray([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.zeros(0, np.int64)
    part = np.lib.stride_tricks.sliding_window_view(h, window)
    return np.unique(np.arange(len(part)) + window - 1 - np.argmin(part[:, ::-1], axis=1))


class Index:
    """Templates' word hashes and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        h, of, _, _, _ = words([templates[n] for n in self.names])
        if len(h) > MAX_WORDS:
            raise ValueError(f"templates have {len(h)} words; every task holds them, so at most {MAX_WORDS}")
        self.words = [h[of == i] for i in range(len(self.names))]
        places: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            if len(w) < GRAM:
                raise ValueError(f"template {self.names[i]!r} has fewer than {GRAM} words")
            g, _ = grams(w, np.zeros(len(w), np.int64), GRAM)
            for j in winnow(g).tolist():
                places.setdefault(int(g[j]), []).append((i, j))
        self.places = places
        self.keys = np.asarray(sorted(places), np.uint64)


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int, int, int]:
    """Best local alignment near ``diagonal`` (text place - template place):
    ``(matches, first, end)`` in words of the text, then first and end in the template."""
    width = 2 * band + 1
    t, x = template.tolist(), text.tolist()
    above = [(0, 0, -1, -1)] * (width + 1)  # (score, matches, first, first of the template) per diagonal; the extra one is out of band
    best = (0, 0, -1, -1, -1, -1)
    for j, word in enumerate(t):
        row = [(0, 0, -1, -1)] * (width + 1)
        for k in range(width):
            i = j + diagonal + k - band
            if i < 0 or i >= len(x):
                continue
            s, m, f, g = above[k]  # the cell up left is the same diagonal one template word before
            if x[i] == word:
                cell = (s + 1, m + 1, i if s <= 0 else f, j if s <= 0 else g)
            else:
                cell = (s - 1, m, f, g)
            s, m, f, g = above[k + 1]  # template word without partner
            if s - 1 > cell[0]:
                cell = (s - 1, m, f, g)
            if k:
                s, m, f, g = row[k - 1]  # text word without partner
                if s - 1 > cell[0]:
                    cell = (s - 1, m, f, g)
            if cell[0] <= 0:
                cell = (0, 0, -1, -1)
            row[k] = cell
            if cell[0] > best[0]:
                best = (cell[0], cell[1], cell[2], i + 1, cell[3], j + 1)
        above = row
    return best[1:]


def chain(parts: list[tuple[int, int, int, int, int]], length: int, band: int = BAND) -> list[tuple[int, int, int]]:
    """Alignments of one template (as ``align`` gives them) -> ``(matches, first, end)``
    of their best chains, each alignment in one chain at most."""
    parts = sorted(set(parts), key=lambda p: (p[1], p[2], p[3]))
    reach = max((p[2] - p[1] for p in parts), default=0) + length
    total, back = [p[0] for p in parts], [-1] * len(parts)
    for n, (m, a, b, ta, tb) in enumerate(parts):
        for o in range(n - 1, -1, -1):
            _, oa, ob, ota, otb = parts[o]
            if a - oa > reach:
                break
            # both ends move on; what overlaps in the template does so in the text, else it is another copy
            if a <= oa or b <= ob or ta <= ota or tb <= otb or a - ob > length or max(0, otb - ta) - max(0, ob - a) > band:
                continue
            gain = m - max(0, otb - ta, ob - a)
            if gain > 0 and total[o] + gain > total[n]:
                total[n], back[n] = total[o] + gain, o
    out, used = [], set()
    for n in sorted(range(len(parts)), key=lambda n: (-total[n], n)):
        steps, o = [], n
        while o >= 0 and o not in used:
            steps.append(o)
            o = back[o]
        if steps:
            used.update(steps)
            head = steps[-1]  # what comes before it may be in a better chain
            out.append((total[n] - total[head] + parts[head][0], parts[head][1], parts[n][2]))
    return sorted(out, key=lambda c: (c[1], c[2]))


def _regions(hits: list[tuple[int, int]], length: int, band: int) -> list[tuple[int, list[int]]]:
    """Candidates among hits (text place, template place) of one template: diagonal
    and text places of the hits.  A candidate that no later hit can reach is closed, so
    the open ones are bounded by the template, not by the text."""
    out: list[tuple[int, list[int]]] = []
    opened: list[list] = []  # last template place, diagonal, text places
    for i, j in sorted(hits):
        d = i - j
        opened = [r for r in opened if i - r[2][-1] <= length]
        for r in opened:
            if abs(d - r[1]) <= band and j >= r[0]:
                r[0] = j
                r[2].append(i)
                break
        else:
            opened.append([j, d, [i]])
            out.append((d, opened[-1][2]))
    return out


def alignments(template: np.ndarray, text: np.ndarray, diagonal: int, hits: list[int], band: int = BAND) -> list[tuple[int, int, int, int, int]]:
    """All alignments near ``diagonal`` that the 3-grams at ``hits`` (ascending) ask for:
    the best one, then the best ones of the words before and behind it that still hold a hit."""
    out = []
    todo = [(max(0, diagonal - band), max(0, min(len(text), diagonal + len(template) + band + 1)))]
    while todo:
        lo, hi = todo.pop()
        k = bisect.bisect_left(hits, lo)
        if k == len(hits) or hits[k] + GRAM > hi:
            continue
        m, a, b, ta, tb = align(template, text[lo:hi], diagonal - lo, band)
        if m:
            out.append((m, a + lo, b + lo, ta, tb))
            todo += [(lo, a + lo), (b + lo, hi)]
    return out


def outer(parts: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Distinct alignments without those that lie inside another one, in the text and in the template
    (a copy that a neighbouring candidate saw in part)."""
    out: list[tuple[int, int, int, int, int]] = []
    held: list[tuple[int, int, int, int, int]] = []  # those that may still reach over what follows
    for p in sorted(set(parts), key=lambda p: (p[1], -p[2], p[3], -p[4])):
        held = [q for q in held if q[2] > p[1]]
        if not any(q[2] >= p[2] and q[3] <= p[3] and q[4] >= p[4] for q in held):
            out.append(p)
            held.append(p)
    return out


def scan_texts(index: Index, texts: list[str | None], coverage: float = COVERAGE, band: int = BAND) -> list[tuple]:
    """``(text number, license, coverage, matched, begin, end)`` of all findings."""
    found: list[tuple] = []
    for start, run in chunks(texts):
        h, of, first, end, raw = words(run)
        g, at = grams(h, of, GRAM)
        if not len(g):
            continue
        near = np.minimum(np.searchsorted(index.keys, g), len(index.keys) - 1)
        hit = np.flatnonzero(index.keys[near] == g)
        if not len(hit):
            continue
        begin = np.searchsorted(of, np.arange(len(run) + 1))
        by: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k in hit.tolist():
            doc = int(of[at[k]])
            for i, j in index.places[int(g[k])]:
                by.setdefault(doc, {}).setdefault(i, []).append((int(at[k]) - int(begin[doc]), j))
        for doc, parts in by.items():
            got: list[tuple] = []
            own = h[begin[doc]:begin[doc + 1]]
            for i, hits in sorted(parts.items()):
                t = index.words[i]
                near_d: list[tuple[int, int, int, int, int]] = []
                for d, at_d in _regions(hits, len(t) + band, band):
                    near_d += alignments(t, own, d, at_d, band)
                for m, a, b in chain(outer(near_d), len(t), band):
                    if m < coverage * len(t):
                        continue
                    w = int(begin[doc])
                    got.append((i, m, int(first[w + a]), int(end[w + b - 1])))
            at_char = _chars(run[doc], raw[doc], sorted({p for f in got for p in f[2:]})) if got else {}
            for i, m, s, e in got:
                found.append((start + doc, index.names[i], m / len(index.words[i]), m, at_char[s][0], at_char[e][1]))
    return found


def _chars(text: str, raw: bytes, places: list[int]) -> dict[int, tuple[int, int]]:
    """Ascending byte places in the lower-cased text -> code points of the text, as the
    begin and as the end of a span; one pass over the text."""
    leads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80  # first bytes of characters
    low = list(accumulate(int(np.count_nonzero(leads[a:b])) for a, b in zip([0, *places], places, strict=False)))
    if len(text.lower()) == len(text):
        return {p: (c, c) for p, c in zip(places, low, strict=True)}
    ends = list(accumulate(len(c.lower()) for c in text))  # lower-casing lengthens a few letters
    return {p: (bisect.bisect_right(ends, c), bisect.bisect_left(ends, c) + 1) for p, c in zip(places, low, strict=True)}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, license, coverage, matched, span_begin, span_end)``."""
    index = Index(TEMPLATES if templates is None else templates)

    def run(batches):
        for pdf in batches:
            ids = pdf["doc_id"].tolist()
            rows = [(ids[k], *rest) for k, *rest in scan_texts(index, pdf["text"].tolist(), coverage)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "matched", "span_begin", "span_end"])
            yield out.astype({"doc_id": "Int64", "coverage": "float64", "matched": "int32", "span_begin": "int64", "span_end": "int64"})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, license string, coverage double, matched int, span_begin long, span_end long")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
