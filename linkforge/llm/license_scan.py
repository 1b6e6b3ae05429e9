"""Operator 5: licence scans by a generalised suffix automaton of licence words.

The automaton holds the words of all templates. A text is streamed through it once: after each word it gives the
length of the longest end of the text so far that stands in some template. Ends of long matches become segments;
segments of one template that follow each other in text and template, with few words between, are chained into a
span, and the words of the template that a chain covers decide on its label: of spans that overlap by half the fullest decide,
of these the longest, as a notice differs from another by a word or two. A match counts for every template that holds it. Beside these there are phrases, found
wherever their words stand consecutively.

Words: ASCII letters (lower-cased), digits and everything outside ASCII; all else separates. Null text counts as
empty: no words, empty labels, score 0. Equal scores: all labels stay. Texts of any length are streamed whole. Repeated
rows give repeated results, empty tables empty ones; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Public licence texts, their usual notices and statements. More are a parameter (see read_templates).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher"),
)

WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD).split() if isinstance(text, str) else []


class SuffixAutomaton:
    """Of several word sequences. Each state of strings of `least` words or more knows every (template, end) where these end."""

    def __init__(self, sequences: list[list[int]], least: int = 1):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.place = [-1], [0], [(-1, -1)]
        self.places: dict[int, set[tuple[int, int]]] = {}
        for k, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._add(last, c, (k, i + 1))
                self.places.setdefault(last, set()).add((k, i + 1))
        for q in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[q]] >= least and q in self.places:
                self.places.setdefault(self.link[q], set()).update(self.places[q])
        #: Places where only a shorter end of a state's strings stands, with its length.
        self.shorter: dict[int, list[tuple[int, int, int]]] = {}
        for q in sorted(self.places, key=self.length.__getitem__):
            up = self.link[q]
            self.shorter[q] = [(k, e, self.length[up]) for k, e in self.places.get(up, set()) - self.places[q]] + self.shorter.get(up, []) if self.length[up] >= least else []

    def standing(self, n: int, state: int) -> dict[tuple[int, int], int]:
        """(template, end) -> length of every match of `least` words or more that ends after a word."""
        return {(k, e): m for k, e, m in self.shorter[state]} | dict.fromkeys(self.places[state], n) if state in self.shorter else {}

    def _new(self, length: int, place: tuple[int, int]) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.place.append(place)
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        r = self._new(self.length[p] + 1, self.place[q])
        self.next[r], self.link[r] = dict(self.next[q]), self.link[q]
        self.link[q] = r
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = r
            p = self.link[p]
        return r

    def _add(self, p: int, c: int, place: tuple[int, int]) -> int:
        q = self.next[p].get(c)
        if q is not None:
            return q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        new = self._new(self.length[p] + 1, place)
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: (length of the longest end that matches, its state)."""
        state = length = 0
        for c in words:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                length += 1
            else:
                state = length = 0
            yield length, state


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least: int = 5, gap: int = 6, cover: float = 0.6):
        """least: words of a segment; gap: words that a chain may skip; cover: share of a template for its label."""
        seqs = [words_of(t) for _, t in templates]
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for s in [*seqs, *(words_of(p) for p, _ in phrases)] for w in s}))}
        self.seqs = [[self.ids[w] for w in s] for s in seqs]
        self.automaton = SuffixAutomaton(self.seqs, least)
        self.labels = [k for k, _ in templates]
        self.phrases = [([self.ids[w] for w in words_of(p)], k) for p, k in phrases]
        self.least, self.gap, self.cover = least, gap, cover

    def spans(self, words: list[int], base: int = 0) -> list[tuple[int, int, int, int]]:
        """(template, first word, word after the last, template words covered) of the chains in a run of words."""
        found, now = [], {}
        for i, (n, state) in enumerate([*self.automaton.statistics(words), (0, 0)]):
            last, now = now, self.automaton.standing(n, state) if n >= self.least else {}
            # matches that the next word doesn't make longer in their own template
            found += [(k, i - m, i, e - m, e) for (k, e), m in sorted(last.items()) if (k, e + 1) not in now]
        chains: dict[int, list] = {}
        out = []
        for k, a, b, s, e in sorted(found, key=lambda x: (x[1], x[2])):
            c = chains.get(k)
            if c and a - c[2] <= self.gap and -self.gap <= s - c[3] <= 4 * self.gap and b > c[2] and e > c[3]:
                c[4] += min(e - s, e - c[3], b - c[2])
                c[2], c[3] = b, e
            else:
                if c:
                    out.append((k, c[1], c[2], c[4]))
                chains[k] = [k, a, b, e, e - s]
        out += [(k, c[1], c[2], c[4]) for k, c in chains.items()]
        return [(k, base + a, base + b, n) for k, a, b, n in out]

    def scan(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
        get = self.ids.get
        parts = [np.fromiter((get(w, 0) for w in words_of(t)), dtype=np.int32) for t in texts]
        gap = np.zeros(1, dtype=np.int32)
        flat = np.concatenate([x for p in parts for x in (p, gap)] or [gap])
        at = np.cumsum([0, *(len(p) + 1 for p in parts)])
        base: dict[int, list[tuple[int, str]]] = {}
        for ids, label in self.phrases:
            n = len(flat) - len(ids) + 1
            hits = np.flatnonzero(flat[: max(n, 0)] == ids[-1] if len(ids) == 1 else flat[len(ids) - 1 :] == ids[-1])
            for j, c in enumerate(ids[:-1]):
                hits = hits[flat[hits + j] == c]
            for x, d in zip(hits.tolist(), (np.searchsorted(at, hits, side="right") - 1).tolist(), strict=True):
                base.setdefault(d, []).append((x - int(at[d]), label))
        known = np.concatenate([[0], (flat > 0).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(known))
        chains: dict[int, list[tuple[int, int, int, int]]] = {}
        runs: list[list[int]] = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= self.least:
                if runs and a - runs[-1][1] <= self.gap and not (np.searchsorted(at, a, side="right") - np.searchsorted(at, runs[-1][0], side="right")):
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        for a, b in runs:
            d = int(np.searchsorted(at, a, side="right") - 1)
            chains.setdefault(d, []).extend(self.spans(flat[a:b].tolist(), a - int(at[d])))
        out = []
        for d, p in enumerate(parts):
            places = base.get(d, [])
            kept, score = [], 0.0
            for k, a, b, n in chains.get(d, []):
                share = n / len(self.seqs[k])
                score = max(score, share)
                if share >= self.cover:
                    kept.append((self.labels[k], a, b, share, n))
            kept = [x[:4] for x in kept if not any(y[3:] > x[3:] and 2 * (min(x[2], y[2]) - max(x[1], y[1])) > min(x[2] - x[1], y[2] - y[1]) for y in kept)]
            first = {label for _, label in places}
            pos = [x for x, _ in places]
            out.append((len(p), len(places), min(pos, default=None), max(pos, default=None), ",".join(sorted(first)), ",".join(sorted(first | {x[0] for x in kept})), 1.0 if places else min(1.0, score), kept))
        return out


_SCANNERS: dict[tuple, Scanner] = {}


def read_templates(folder: str) -> tuple[tuple[str, str], ...]:
    """(label, text) of the text files in a folder of the driver, label.txt or label.2.txt and so on."""
    from pathlib import Path

    return tuple((p.name.split(".")[0], p.read_text(encoding="utf-8")) for p in sorted(Path(folder).glob("*.txt")))


def scan(docs: DataFrame, spans: bool = False, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per row of docs (doc_id, text) what Scanner.scan gives; spans=True: with the covered spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if (phrases, templates) not in _SCANNERS:
            _SCANNERS[phrases, templates] = Scanner(phrases, templates)
        scanner = _SCANNERS[phrases, templates]
        for b in batches:
            for i in range(0, len(b), 512):
                part = b.iloc[i : i + 512]
                rows = scanner.scan(part["text"].tolist())
                out = pd.DataFrame([r if spans else r[:-1] for r in rows], columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", *["spans"] * spans])
                for c in ("first_word", "last_word"):
                    out[c] = out[c].astype("Int64")
                if spans:
                    out["spans"] = [[{"label": k, "first": a, "end": e, "cover": s} for k, a, e, s in x] for x in out["spans"]]
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double" + ", spans array<struct<label:string,first:long,end:long,cover:double>>" * spans
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of operator 5 SQL can say: words and places of the phrases."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


QUERIES = {"op5_license_scan": op5_license_scan, "license_phrases": license_phrases}
SQL = {
    "license_phrases": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
p(q, label) AS (VALUES (['under', 'the', 'mit', 'license'], 'mit'), (['apache', 'license', 'version', '2'], 'apache-2'), (['cc', 'by', 'nc'], 'cc-by-nc')),
h AS (SELECT doc_id, label, unnest(list_filter(range(0, len(w) - len(q) + 1), lambda i: w[i + 1 : i + len(q)] = q)) AS i FROM d, p),
a AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(labels, '') AS base_labels
FROM d LEFT JOIN a ON a.doc_id = d.doc_id"""
}
