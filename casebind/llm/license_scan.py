"""Licence notices in texts: matching statistics against a generalised suffix automaton.

The automaton is built over the words of all templates (hundreds of words, shipped with the
task). A text is streamed through it once; after each word the longest run of words that ends
there and stands in some template is known (its matching statistic). Runs of at least
``MIN_MATCH`` words are chained, per template, in the order of both text and template, into
spans; a template whose words are covered by ``MIN_COVER`` or more gives its label.
Whole phrases are templates too, and every place of one is reported.

A notice of several sentences is one template for each, as files often keep only a part. A run of
words that a template holds twice is taken for its first place there, so of a repeated passage the
second place adds nothing to the share that is covered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebind.llm.arrays import ALPHANUMERIC, hashed, pieces, text_bytes, words

MIN_MATCH, MIN_COVER, MAX_GAP = 3, 0.6, 8

# Phrases whose every place is reported, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices as their licences ask for them, and the labels they give.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files, to deal in the software without"
            " restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies"
            " or substantial portions of the Software"),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
            " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
            " PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("mit", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT"
            " HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
            " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE"
            " OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed"
                   " under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
                   " CONDITIONS OF ANY KIND, either express or implied"),
    ("apache-2.0", "See the License for the specific language governing permissions and"
                   " limitations under the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the"
            " terms of the GNU General Public License as published by the Free Software"
            " Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY"
            " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
            " PARTICULAR PURPOSE. See the GNU General Public License for more details"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
            " permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of"
            " conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list"
            " of conditions and the following disclaimer in the documentation and/or other"
            " materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be"
            " used to endorse or promote products derived from this software without specific"
            " prior written permission"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
            " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES"
            " OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    ("bsd", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,"
            " INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT"
            " NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR"
            " PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
            " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
            " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
            " POSSIBILITY OF SUCH DAMAGE"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with"
            " or without fee is hereby granted, provided that the above copyright notice and this"
            " permission notice appear in all copies"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no"
             " event will the authors be held liable for any damages arising from the use of this"
             " software"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone"
                  " is free to copy, modify, publish, use, compile, sell, or distribute this"
                  " software, either in source code form or as a compiled binary, for any purpose,"
                  " commercial or non-commercial, and by any means"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of"
                " the Eclipse Public License 2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International"
              " License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related"
            " or neighboring rights to this work"),
]


def _split(texts: list[str]) -> list[list[str]]:
    w = words(pa.array(texts, pa.large_string()), ALPHANUMERIC, lower=True)
    raw = w.data.tobytes()
    flat = [raw[s:e].decode() for s, e in zip(w.start.tolist(), w.end.tolist(), strict=True)]
    return [flat[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


@dataclass
class Automaton:
    """Every run of words of every template is a path from state 0."""

    templates: list[list[int]]
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    longest: list[int] = field(default_factory=lambda: [0])
    #: per state: template to the end of the state's first occurrence in it
    ends: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def __post_init__(self) -> None:
        for t, ids in enumerate(self.templates):
            last = 0
            for at, word in enumerate(ids):
                last = self._extend(last, word)
                self.ends[last].setdefault(t, at + 1)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.longest[s]):
            above = self.ends[self.link[state]]
            for t, end in self.ends[state].items():
                above[t] = min(end, above.get(t, end))

    def _new(self, longest: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append({})
        return len(self.link) - 1

    def _split_off(self, parent: int, word: int) -> int:
        """The state that ``word`` leads to from ``parent``, made to hold one length only."""
        target = self.step[parent][word]
        if self.longest[target] == self.longest[parent] + 1:
            return target
        twin = self._new(self.longest[parent] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = twin
        while parent >= 0 and self.step[parent].get(word) == target:
            self.step[parent][word] = twin
            parent = self.link[parent]
        return twin

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split_off(last, word)
        state = self._new(self.longest[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._split_off(at, word)
        return state

    def statistics(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the length of the longest match that ends there, and its state."""
        state, length = 0, 0
        for word in ids:
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.longest[state]
            if word in self.step[state]:
                state, length = self.step[state][word], length + 1
            yield length, state


class Scanner:
    """Finds phrases and covered notices in the words of texts."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str]]):
        texts = _split([*phrases, *(text for _, text in notices)])
        self.labels = [*phrases.values(), *(label for label, _ in notices)]
        vocabulary = sorted({x for text in texts for x in text})
        number = {x: i for i, x in enumerate(vocabulary)}
        raw, at = text_bytes(pa.array(vocabulary, pa.large_string()))
        h = hashed(raw, at[:-1], at[1:])
        order = np.argsort(h)
        self.hash, self.number = h[order], order
        self.automaton = Automaton([[number[x] for x in text] for text in texts])
        self.sizes = [len(t) for t in texts]
        self.n_phrases = len(phrases)
        self.shortest = min([MIN_MATCH, *self.sizes[:len(phrases)]])
        # per state, the phrases that end wherever it is reached with their length or more
        a, self.phrase_at = self.automaton, []
        ends = {}
        for p, ids in enumerate(a.templates[:len(phrases)]):
            state = 0
            for word in ids:
                state = a.step[state][word]
            ends.setdefault(state, []).append(p)
        for state in range(len(a.link)):
            found, at_state = [], state
            while at_state > 0:
                found += ends.get(at_state, [])
                at_state = a.link[at_state]
            self.phrase_at.append(found)

    def runs(self, h: np.ndarray, doc: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """Stretches of neighbouring words that are all in the vocabulary and long enough for a match
        or a phrase."""
        spot = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        at = np.flatnonzero(self.hash[spot] == h)
        if not len(at):
            return
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) > 1) | (doc[at[1:]] != doc[at[:-1]])
        heads = np.append(np.flatnonzero(new), len(at))
        for k in np.flatnonzero(np.diff(heads) >= self.shortest):
            a, b = heads[k], heads[k + 1]
            d = int(doc[at[a]])
            yield d, int(at[a] - first[d]), self.number[spot[at[a:b]]].tolist()

    def matches(self, start: int, ids: list[int], places: list, found: dict) -> None:
        """Adds the phrases' places and the maximal matches (by template) of one run of words."""
        a = self.automaton
        before = (0, 0)
        for i, now in enumerate([*a.statistics(ids), (0, 0)]):
            length, state = now
            for p in self.phrase_at[state]:
                if self.sizes[p] <= length:
                    places.append((start + i + 1 - self.sizes[p], p))
            if before[0] >= MIN_MATCH and length != before[0] + 1:
                for t, end in a.ends[before[1]].items():
                    if t >= self.n_phrases:
                        found.setdefault(t, []).append((start + i - before[0], before[0], end))
            before = now

    def covered(self, t: int, found: list[tuple[int, int, int]]) -> tuple[float, int, int]:
        """Best chain of matches in text and template order: share covered, first and end word."""
        best, chains = (0.0, 0, 0), []
        for at, n, end in found:
            chain = (n, at, at + n, end)
            for covered, first, stop, t_end in reversed(chains):  # matches end one after another
                if stop < at - MAX_GAP:
                    break
                new = end - max(end - n, t_end)
                if stop <= at and new > 0 and covered + new > chain[0]:
                    chain = (covered + new, first, at + n, end)
            chains.append(chain)
            if chain[0] / self.sizes[t] > best[0]:
                best = (min(1.0, chain[0] / self.sizes[t]), chain[1], chain[2])
        return best


def scan_licences(docs: DataFrame, phrases: dict[str, str] = PHRASES,
                  notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and spans (label, first word, end, share of the notice covered).

    Words are runs of ASCII letters (lower-cased), digits and everything beyond ASCII. ``n_base``
    counts all places of the phrases, overlapping ones too; score is the largest covered share
    of a notice or phrase. A null text is empty; without a match counts are 0, labels empty and
    the two places null. One pass, no shuffle; texts are read whole.
    """
    scanner = Scanner(phrases, notices)
    names = list(phrases)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield scan_part(part)

    def scan_part(part: pa.RecordBatch) -> pa.RecordBatch:
        w = words(part.column("text"), ALPHANUMERIC, lower=True)
        n = part.num_rows
        places, found = [[] for _ in range(n)], [{} for _ in range(n)]
        for d, start, ids in scanner.runs(w.hash, w.doc, w.first):
            scanner.matches(start, ids, places[d], found[d])
        rows = []
        for d in range(n):
            base = {phrases[names[p]] for _, p in places[d]}
            spans = [{"label": scanner.labels[p], "first_word": at, "end_word": at + scanner.sizes[p],
                      "cover": 1.0} for at, p in places[d]]
            score = 1.0 if base else 0.0
            labels = set(base)
            for t, matches in found[d].items():
                cover, first, end = scanner.covered(t, matches)
                score = max(score, cover)
                if cover >= MIN_COVER:
                    labels.add(scanner.labels[t])
                    spans.append({"label": scanner.labels[t], "first_word": first,
                                  "end_word": end, "cover": cover})
            at = [a for a, _ in places[d]]
            rows.append((len(at), min(at, default=None), max(at, default=None),
                         ",".join(sorted(base)), ",".join(sorted(labels)), score, spans))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                 pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                     ("end_word", pa.int64()), ("cover", pa.float64())]))]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id").cast(pa.int64()), pa.array(w.counts(), pa.int64()),
             *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
             "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
              "base_labels string, labels string, score double, spans array<struct<label: string, "
              "first_word: long, end_word: long, cover: double>>")
