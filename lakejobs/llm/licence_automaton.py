"""License scan with a generalised suffix automaton over the words of license templates.

The automaton holds every run of words that occurs in a template. A file is streamed through it:
after each word, the matching statistic is the longest run ending there that some template
holds. Locally longest matches of enough words are chained, per template and in the order of
the template, into spans; the words a chain covers give the template's score. Base phrases
are looked for exactly, beside it.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text, licence_texts

# The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Well-known notices, from the licenses' public texts.
NOTICES = {
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular "
        "purpose see the gnu general public license for more details",
        "you should have received a copy of the gnu general public license along with this "
        "program if not see https www gnu org licenses",
    ],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation",
    ],
    "apache": [
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without "
        "warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license",
    ],
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions",
        "the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source code "
        "must retain the above copyright notice this list of conditions and the following "
        "disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution",
    ],
    "cc-by": [
        "this work is licensed under a creative commons attribution 4 0 international license",
        "licensed under cc by 4 0",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
    "cc0": [
        "to the extent possible under law the author has waived all copyright and related or "
        "neighboring rights to this work",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at https mozilla "
        "org mpl 2 0",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
    ],
}

# Notices and whole texts; a label stands where three quarters of one of them do.
TEMPLATES = licence_texts.joined(NOTICES, licence_texts.TEXTS)

MIN_MATCH = 4
MIN_COVERED = 0.75

WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[65:91] = WORD[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class SuffixAutomaton:
    """All runs of symbols of several sequences; each state knows where its runs end first in
    every sequence that holds them."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]
        visits = []
        for number, sequence in enumerate(sequences):
            last = 0
            for at, symbol in enumerate(sequence):
                last = self._extend(last, symbol)
                visits.append((last, number, at))
        # Places reach the states of shorter runs along the suffix links.
        for state, number, at in visits:
            while state > 0:
                self.ends[state].setdefault(number, []).append(at)
                state = self.link[state]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, state: int, symbol: int, old: int) -> int:
        clone = self._state(self.length[state] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = clone
        while state >= 0 and self.next[state].get(symbol) == old:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        old = self.next[last].get(symbol)
        if old is not None:  # another sequence has this run already
            if self.length[old] == self.length[last] + 1:
                return old
            return self._split(last, symbol, old)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and symbol not in self.next[state]:
            self.next[state][symbol] = new
            state = self.link[state]
        if state >= 0:
            old = self.next[state][symbol]
            fits = self.length[old] == self.length[state] + 1
            self.link[new] = old if fits else self._split(state, symbol, old)
        return new

    def stream(self, symbols) -> list[tuple[int, int]]:
        """The matching statistics: (length, state) after each symbol."""
        state = length = 0
        out = []
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            follow = self.next[state].get(symbol)
            if follow is None:
                state = length = 0
            else:
                state, length = follow, length + 1
            out.append((length, state))
        return out


class LicenceScanner:
    """Templates, their automaton and the base phrases, over word hashes."""

    def __init__(self, templates: dict[str, list[str]], phrases: dict[str, str]):
        self.labels = [label for label, texts in templates.items() for _ in texts]
        texts = [text.split() for texts in templates.values() for text in texts]
        wanted = [phrase.split() for phrase in phrases]
        vocabulary = sorted({w for t in texts + wanted for w in t})
        raw, at = arrow_text.utf8(pa.array(vocabulary, pa.string()))
        hashes = arrow_text.span_hashes(raw, at[:-1], at[1:])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.small = np.zeros(1 << 16, bool)
        self.small[(hashes & np.uint64(0xFFFF)).astype(int)] = True
        number = {vocabulary[i]: k + 1 for k, i in enumerate(order)}
        self.sequences = [[number[w] for w in t] for t in texts]
        self.phrases = [([number[w] for w in p], label)
                        for p, label in zip(wanted, phrases.values(), strict=True)]
        self.automaton = SuffixAutomaton(self.sequences)

    def symbols(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """1.. for words of the vocabulary, 0 for all others."""
        hashes = arrow_text.span_hashes(raw, begin, end)
        out = np.zeros(len(hashes), np.int32)
        maybe = np.flatnonzero(self.small[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[found] == hashes[maybe]
        out[maybe[same]] = found[same] + 1
        return out

    def matches(self, run: list[int], first: int):
        """Locally longest matches of a run: (template, word in template, word in text, words)."""
        stats = self.automaton.stream(run)
        for i, (length, state) in enumerate(stats):
            if length < MIN_MATCH or (i + 1 < len(stats) and stats[i + 1][0] > length):
                continue
            for template, ends in self.automaton.ends[state].items():
                for end in ends:
                    yield template, end - length + 1, first + i - length + 1, length

    def chain(self, found: list[tuple[int, int, int]], size: int) -> list[tuple]:
        """Spans of one template: chains of matches in the order of text and template, with gaps
        of at most the template's size; (first word, end, share of the template covered)."""
        found = sorted(found, key=lambda m: (m[1], m[0], m[2]))
        best: list[tuple[int, int, int]] = []  # covered words, first word, previous
        alive = 0
        for i, (at, place, words) in enumerate(found):
            while alive < i and found[alive][1] + found[alive][2] + size < place:
                alive += 1
            top = (words, place)
            for j in range(alive, i):
                a, p, w = found[j]
                skip = max(0, a + w - at, p + w - place)
                if a <= at and p < place and skip < words and place - best[j][1] < 2 * size:
                    top = max(top, (best[j][0] + words - skip, best[j][1]),
                              key=lambda x: (x[0], x[1]))
            best.append(top)
        spans: dict[int, tuple[int, int]] = {}
        for (covered, first), (_, place, words) in zip(best, found, strict=True):
            if first not in spans or covered > spans[first][0]:
                spans[first] = (covered, place + words)
        return [(first, end, covered / size) for first, (covered, end) in sorted(spans.items())
                if covered / size >= MIN_COVERED]

    def scan(self, texts: pa.Array) -> list[dict]:
        """For each text: words, base places, labels, best score and template spans."""
        raw, at = arrow_text.utf8(texts)
        raw = LOWER[raw]
        begin, end, owner = arrow_text.runs(WORD[raw], at)
        symbol = self.symbols(raw, begin, end)
        words = np.bincount(owner, minlength=len(texts))
        first_word = np.concatenate([[0], np.cumsum(words)])
        out = [{"n_words": int(n), "base": [], "base_labels": set(), "labels": set(),
                "score": 0.0, "spans": []} for n in words]
        for sequence, label in self.phrases:
            n = len(sequence)
            if len(symbol) < n:
                continue
            hit = owner[:len(owner) - n + 1] == owner[n - 1:]
            for i, s in enumerate(sequence):
                hit &= symbol[i:len(symbol) - n + 1 + i] == s
            for place in np.flatnonzero(hit).tolist():
                row = out[owner[place]]
                row["base"].append(place - int(first_word[owner[place]]))
                row["base_labels"].add(label)
        known = np.zeros(len(symbol) + 2, np.int8)
        known[1:-1] = symbol > 0
        step = np.diff(known)
        edges = first_word[np.flatnonzero(words)]  # words that begin a text
        inner = edges[(known[edges] == 1) & (known[edges + 1] == 1)]
        starts = np.union1d(np.flatnonzero(step == 1), inner)
        stops = np.union1d(np.flatnonzero(step == -1), inner)
        long = stops - starts >= MIN_MATCH
        found: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            text = int(owner[a])
            for template, place, word, n in self.matches(
                    symbol[a:b].tolist(), a - int(first_word[text])):
                found[text][template].append((place, word, n))
        for text, by_template in found.items():
            row = out[text]
            for template, matches in by_template.items():
                for first, last, share in self.chain(matches, len(self.sequences[template])):
                    row["spans"].append((self.labels[template], first, last, share))
        for row in out:
            row["spans"].sort(key=lambda s: (s[1], s[2], s[0]))
            row["labels"] = row["base_labels"] | {s[0] for s in row["spans"]}
            row["score"] = max([1.0 if row["base"] else 0.0, *(s[3] for s in row["spans"])])
        return out


_SCANNERS: dict[str, LicenceScanner] = {}
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, "
          "spans array<struct<label:string,first_word:long,end_word:long,covered:double>>")
RESULT_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                  ("end_word", pa.int64()), ("covered", pa.float64())]))),
])


def _scanner(templates, phrases) -> LicenceScanner:
    key = repr((templates, phrases))
    if key not in _SCANNERS:
        _SCANNERS[key] = LicenceScanner(templates, phrases)
    return _SCANNERS[key]


def scanned(text: Column, templates: dict[str, list[str]] | None = None,
            phrases: dict[str, str] | None = None) -> Column:
    """Struct of all findings in a whole text (null: empty); templates are lower-case words."""
    templates, phrases = templates or TEMPLATES, phrases or PHRASES

    @F.arrow_udf(RESULT)
    def scan_texts(texts: pa.Array) -> pa.Array:
        scanner = _scanner(templates, phrases)
        rows = []
        for _, part in arrow_text.slices(texts):
            for r in scanner.scan(part):
                rows.append({
                    "n_words": r["n_words"], "n_base": len(r["base"]),
                    "first_word": min(r["base"], default=None),
                    "last_word": max(r["base"], default=None),
                    "base_labels": ",".join(sorted(r["base_labels"])),
                    "labels": ",".join(sorted(r["labels"])), "score": r["score"],
                    "spans": [dict(zip(("label", "first_word", "end_word", "covered"), s,
                                       strict=True)) for s in r["spans"]]})
        return pa.array(rows, RESULT_TYPE)

    return scan_texts(text)


def scan(docs: DataFrame, text_col: str = "text", out: str = "licences") -> DataFrame:
    """Add the struct of :func:`scanned` as column ``out``, which replaces one of that name."""
    return docs.withColumn(out, scanned(F.col(f"`{text_col}`")))
