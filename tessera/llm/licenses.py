"""Operator 7: license texts and notices in documents, by winnowed fingerprints and
banded alignment.

Templates are cut into tokens (runs of letters and digits, lower case); of the hashes of their
3-token strings, winnowing keeps the smallest of each two neighbours, and an inverted index
maps them to template and place. Every text's 3-token strings, all of them, are looked up; hits on near
diagonals are one candidate. A candidate is aligned with the template inside a band around
its diagonals (longest common subsequence), which gives coverage (matched share of the
template's tokens) and the matched spans as byte ranges of the text. Any four tokens in a row
that a text shares with a template make a candidate. Longer insertions part a text into candidates on
diagonals further apart: those less than ``coverage`` of the template's length apart, fewer than two
whole copies, are chained by the longest increasing run through all their matched places.

The index is a few kilobytes and goes with the tasks; scanning is a projection without a shuffle,
so a notice in a third of all documents is no hot key.

Defined cases: null, empty or token-free texts have no match; repeated rows are reported each;
an alignment that overlaps a better one of the same template is dropped, ties go to the
first; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import M61, lower_ascii, mix, spans, text_bytes, tidy, word_cuts, word_hashes

GRAM = 3
WINNOW = 2
BAND = 8
COVERAGE = 0.8
CHUNK = 1 << 20

#: Public license texts and notices.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
}

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def tokens(data: np.ndarray, off: np.ndarray):
    """(hash, start, end, row) of the tokens of a byte table."""
    data = lower_ascii(data)
    data = np.where(_TOKEN[data], data, 32).astype(np.uint8)
    starts, ends, row = word_cuts(data, off)
    return word_hashes(data, starts, ends), starts, ends, row


def grams(h: np.ndarray) -> np.ndarray:
    """Hashes of the token strings that start at each place."""
    n = max(0, len(h) - GRAM + 1)
    with np.errstate(over="ignore"):
        g = h[:n].copy()
        for k in range(1, GRAM):
            g = g * M61 + h[k:k + n]
        return mix(g)


def winnowed(g: np.ndarray) -> list[int]:
    """Places of the smallest hash in each window, the last one on ties."""
    if len(g) < WINNOW:
        return list(range(len(g)))
    picks = {i + WINNOW - 1 - int(np.argmin(g[i:i + WINNOW][::-1])) for i in range(len(g) - WINNOW + 1)}
    return sorted(picks)


class Index:
    """Inverted index of the winnowed fingerprints of templates."""

    def __init__(self, templates: dict[str, str]):
        self.names, self.tokens, found = [], [], []
        for name, text in templates.items():
            raw = np.frombuffer(text.encode(), np.uint8)
            h = tokens(raw, np.array([0, len(raw)]))[0]
            if len(h) < GRAM:
                raise ValueError(f"template {name} has fewer than {GRAM} tokens")
            g = grams(h)
            found += [(int(g[p]), len(self.names), p) for p in winnowed(g)]
            self.names.append(name)
            self.tokens.append(h)
        found.sort()
        self.hash = np.array([f[0] for f in found], np.uint64)
        self.where = [(f[1], f[2]) for f in found]

    def hits(self, g: np.ndarray):
        """(place in ``g``, template, place in the template) of every match."""
        lo = np.searchsorted(self.hash, g, "left")
        some = np.flatnonzero(self.hash[np.minimum(lo, len(self.hash) - 1)] == g)
        for p in some.tolist():
            k = int(lo[p])
            while k < len(self.hash) and self.hash[k] == g[p]:
                yield (p, *self.where[k])
                k += 1


def band(size: int) -> int:
    """Band of a template: a quarter of its tokens, ``BAND`` at most, so that one copy of a
    short notice is not aligned with the next."""
    return max(1, min(BAND, size // 4))


def align(template: np.ndarray, text: np.ndarray, diagonals: tuple[int, int]) -> list[tuple[int, int]]:
    """Longest common subsequence inside a band: matched (template, text) places. A cell (i, j) is in
    the band if j - i lies between the diagonals, widened by the template's band."""
    wide = band(len(template))
    lo, hi = diagonals[0] - wide, diagonals[1] + wide
    m, width = len(template), hi - lo + 1
    best = np.zeros((m + 1, width + 2), np.int32)
    cols = np.arange(width)
    for i in range(m):
        j = i + lo + cols
        inside = (j >= 0) & (j < len(text))
        equal = inside & (text[np.clip(j, 0, max(len(text) - 1, 0))] == template[i])
        # best[i + 1, d] is over template[:i + 1] and text up to j = i + lo + d - 1 inclusive
        row = np.maximum(best[i, 2:width + 2], best[i, 1:width + 1] + equal)
        best[i + 1, 1:width + 1] = np.maximum.accumulate(row)
        best[i + 1, width + 1] = best[i + 1, width]
    out, i, d = [], m, width
    while i > 0 and d > 0:
        if best[i, d] == best[i, d - 1]:
            d -= 1
        elif best[i, d] == best[i - 1, d + 1]:
            i, d = i - 1, d + 1
        else:
            out.append((i - 1, i - 1 + lo + d - 1))
            i -= 1
    return out[::-1]


def chained(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of (template, text) places that rises in both."""
    ends, last, before = [], [], {}
    for q, p in sorted(set(pairs), key=lambda x: (x[0], -x[1])):
        k = bisect_left(ends, p)
        before[q, p] = last[k - 1] if k else None
        ends[k:k + 1], last[k:k + 1] = [p], [(q, p)]
    out, at = [], last[-1] if last else None
    while at is not None:
        out.append(at)
        at = before[at]
    return out[::-1]


def on_diagonal(template: np.ndarray, text: np.ndarray, d: int) -> list[tuple[int, int]]:
    """Equal (template, text) places with text place - template place = ``d``."""
    a, z = max(0, -d), min(len(template), len(text) - d)
    return [(i, i + d) for i in (a + np.flatnonzero(template[a:z] == text[a + d:z + d])).tolist()]


def matches(index: Index, h: np.ndarray, coverage: float = COVERAGE) -> list[tuple[int, float, list[int]]]:
    """(template, coverage, matched places in the text) for one text's tokens."""
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, t, q in index.hits(grams(h)):
        by[t].append((p - q, p))
    out = []
    for t, hits in sorted(by.items()):
        size, found = len(index.tokens[t]), []
        hits.sort()
        groups: list[list[tuple[int, int]]] = []
        for hit in hits:
            if groups and hit[0] - groups[-1][-1][0] <= band(size) and hit[0] - groups[-1][0][0] < size // 2:
                groups[-1].append(hit)
            else:
                groups.append([hit])
        aligned = []
        for group in groups:
            lo, hi = group[0][0], group[-1][0]
            start = max(0, lo - band(size))
            part = h[start:hi + size + band(size) + 1]
            pairs = align(index.tokens[t], part, (lo - start, hi - start))
            aligned.append((lo, hi, [(i, start + j) for i, j in pairs], group))
            if len(pairs) >= coverage * size:
                found.append((len(pairs) / size, False, [start + j for _, j in pairs]))
        done = 0
        for k, (lo, *_) in enumerate(aligned):
            stop = k + 1
            while stop < len(aligned) and aligned[stop][1] - lo < coverage * size:
                stop += 1
            if stop > max(done, k + 1):
                done = stop
                # an alignment may give a place of its own part away for several chance ones: the diagonals have it
                pairs = [x for a in aligned[k:stop] for x in a[2]]
                for d in {d for a in aligned[k:stop] for d, _ in a[3]}:
                    pairs += on_diagonal(index.tokens[t], h, d)
                # a chain adds at least the tokens of one hit to its best candidate
                least = max(coverage * size, max(len(a[2]) for a in aligned[k:stop]) + GRAM)
                if len({i for i, _ in pairs}) >= least and len(run := chained(pairs)) >= least:
                    found.append((len(run) / size, True, [j for _, j in run]))
        found.sort(key=lambda x: (-x[0], x[1], x[2][0]))
        taken: list[tuple[int, int]] = []
        for share, _, places in found:
            if all(places[-1] < a or places[0] > b for a, b in taken):
                taken.append((places[0], places[-1]))
                out.append((t, share, places))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, start, end, spans) of every match: byte range of the match and its
    matched runs."""
    templates = templates or TEMPLATES

    def run(batches):
        index = Index(templates)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            ids = b.column(0).to_pylist()
            data, off = text_bytes(b.column(1))
            out = []
            for i, j in spans(off, CHUNK):
                cut = off[i:j + 1] - off[i]
                h, starts, ends, row = tokens(data[off[i]:off[j]], cut)
                g = grams(h)
                lo = np.searchsorted(index.hash, g)
                hit = index.hash[np.minimum(lo, len(index.hash) - 1)] == g
                first = np.searchsorted(row, np.arange(j - i + 1))
                for k in np.unique(row[:len(g)][hit]).tolist():
                    a, z = int(first[k]), int(first[k + 1])
                    s, e = starts[a:z] - cut[k], ends[a:z] - cut[k]
                    for t, share, places in matches(index, h[a:z], coverage):
                        runs, last = [], None
                        for p in places:
                            if p - 1 == last:
                                runs[-1]["end"] = int(e[p])
                            else:
                                runs.append({"start": int(s[p]), "end": int(e[p])})
                            last = p
                        out.append((ids[i + k], index.names[t], share, runs[0]["start"], runs[-1]["end"], runs))
            if out:
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1]), pa.array(c[2], pa.float64()), pa.array(c[3], pa.int64()),
                     pa.array(c[4], pa.int64()), pa.array(c[5], kind)],
                    ["doc_id", "license", "coverage", "start", "end", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        tidy(run), "doc_id bigint, license string, coverage double, start bigint, end bigint, "
             "spans array<struct<start: bigint, end: bigint>>")
