"""License texts found by a generalised suffix automaton of their words.

The automaton holds every run of words of all templates. A text's words are streamed through it: after each word it
stands at the longest run of template words that ends there, the *matching statistic*, and its state names every place
in the templates where that run ends. Runs that can't be made longer are matches; matches that follow each other both
in the text and in a template, with small gaps, are chained into a span, and a span that covers enough of the template's
words gives the template's label. The base phrases are templates of the same automaton: a phrase stands wherever the
statistic is at least its length and the state, or one its suffix links lead to, is the phrase's.

Most words are in no template, and most pairs of neighbours stand together in none. There the statistic is 0 or 1 and the
automaton needn't be walked: whole texts are looked at in one go, and only stretches of known pairs are walked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logweir.llm.common import bytes_of, slices

# A word: a longest run of a-z, digits and characters beyond ASCII, after A-Z are lower-cased.
_WORDS_OF_BYTES = re.compile(rb"[0-9a-z\x80-\xFF]+").findall

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# What licences say of themselves, as published with them: notices to put into files, and sentences by
# which texts name their licence. (label, text); a label may have several.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
            "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
                   "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
            "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
            "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
            "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                  "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                  "non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
             "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

# Matches of fewer words than this are not chained.
MIN_MATCH = 3
# Most words between two matches of a chain, in the text and in the template.
GAP = 8
# The share of a template's words that a span must cover, in percent.
COVERED = 75


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased."""
    return _WORDS_OF_BYTES(text.lower())


class Automaton:
    """Generalised suffix automaton of sequences of word numbers; its states number at most twice the words.

    ``sequences``: lists of word numbers. Per state: transitions ``steps``, suffix link ``link``, length ``size`` of its
    longest run, and ``ends``, the places (sequence, position after the run's last word) at which its runs end.
    """

    def __init__(self, sequences: list[list[int]]):
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for s, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence, 1):
                last = self._longer(last, word, ends)
                ends[last].append((s, at))
        # A run ends wherever a longer run that it is a suffix of does.
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            ends[self.link[state]] += ends[state]
        self.ends = [tuple(sorted(set(e))) for e in ends]

    def _new(self, size: int, ends: list) -> int:
        self.steps.append({})
        self.link.append(0)
        self.size.append(size)
        ends.append([])
        return len(self.size) - 1

    def _split(self, p: int, word: int, ends: list) -> int:
        """The state of the run that ``word`` makes of ``p``'s longest one, by splitting the one it leads to if that holds longer ones."""
        q = self.steps[p][word]
        if self.size[q] == self.size[p] + 1:
            return q
        part = self._new(self.size[p] + 1, ends)
        self.steps[part], self.link[part] = dict(self.steps[q]), self.link[q]
        self.link[q] = part
        while p >= 0 and self.steps[p].get(word) == q:
            self.steps[p][word] = part
            p = self.link[p]
        return part

    def _longer(self, last: int, word: int, ends: list) -> int:
        if word in self.steps[last]:  # an earlier sequence has this run
            return self._split(last, word, ends)
        state, p = self._new(self.size[last] + 1, ends), last
        while p >= 0 and word not in self.steps[p]:
            self.steps[p][word] = state
            p = self.link[p]
        self.link[state] = 0 if p < 0 else self._split(p, word, ends)
        return state

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: length of the longest run that ends there, and its state."""
        state = size = 0
        for word in words:
            while state and word not in self.steps[state]:
                state = self.link[state]
                size = self.size[state]
            state = self.steps[state].get(word, 0)
            size = size + 1 if state else 0
            yield size, state


class Scanner:
    """Base phrases and covered template spans of texts.

    ``templates``: (label, text) pairs held by the driver; their automaton goes with the job.
    """

    def __init__(self, templates: list[tuple[str, str]], min_match: int = MIN_MATCH, gap: int = GAP, covered: int = COVERED):
        if min_match < 2 or gap < 0 or not 0 < covered <= 100:
            raise ValueError("min_match must be 2 or more, gap 0 or more, covered from 1 to 100")
        self.min_match, self.gap, self.covered = min_match, gap, covered
        held = [(label, words_of(text.encode())) for label, text in templates]
        self.labels = [label for label, words in held if words]
        texts = [words for _, words in held if words]
        self.sizes = list(map(len, texts))
        phrases = [words_of(p.encode()) for p in PHRASES]
        self.number = {w: n for n, w in enumerate(sorted({w for t in texts + phrases for w in t}))}
        coded = [[self.number[w] for w in t] for t in texts + phrases]
        self.automaton = Automaton(coded)
        pairs = {(a, b) for c in coded for a, b in zip(c, c[1:])}
        self.pairs = np.array(sorted(a * len(self.number) + b for a, b in pairs), np.int64)
        # The phrases at the end of a state's runs: (words, label), by following its suffix links.
        whole = {}
        for c, label in zip(coded[len(texts):], PHRASES.values()):
            *_, (_, state) = self.automaton.statistics(c)
            whole[state] = (len(c), label)
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.automaton.size)
        for state in sorted(range(len(self.phrases)), key=self.automaton.size.__getitem__):
            above = self.phrases[self.automaton.link[state]] if state else ()
            self.phrases[state] = above + ((whole[state],) if state in whole else ())

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, int, int]]]:
        """Base phrases (start, label) and template spans (label, start, stop, words covered, words of the template)."""
        numbers = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        base: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []
        if len(numbers) > 1 and len(self.pairs):
            pairs = np.where((numbers[:-1] >= 0) & (numbers[1:] >= 0), numbers[:-1] * len(self.number) + numbers[1:], -1)
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            edge = np.diff(np.r_[False, self.pairs[at] == pairs, False].astype(np.int8))
            for start, stop in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist()):
                self._walk(numbers[start:stop].tolist(), start, base, matches)
        return base, self._chains(matches)

    def _walk(self, numbers: list[int], first: int, base: list, matches: list) -> None:
        """Phrases and matches (start, stop, state) of a stretch whose first word has number ``first`` in the text."""
        before = (0, 0)
        for at, (size, state) in enumerate(self.automaton.statistics(numbers), first):
            for n, label in self.phrases[state]:
                if n <= size:
                    base.append((at + 1 - n, label))
            if size <= before[0] >= self.min_match:  # the run before was not made longer
                matches.append((at - before[0], at, before[1]))
            before = (size, state)
        if before[0] >= self.min_match:
            matches.append((first + len(numbers) - before[0], first + len(numbers), before[1]))

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, int, int]]:
        """Spans that cover enough of a template.

        Per template one chain is open at a time. A match goes on with it at the first of its places in the template
        that lies behind the chain's end there, if neither gap is too wide; words that overlap count once. Otherwise
        the chain is closed and the match begins another at its first place.
        """
        open_at: dict[int, list[int]] = {}  # template: start and stop in the text, stop in the template, words covered
        found: list[tuple[str, int, int, int, int]] = []

        def close(template: int) -> None:
            start, stop, _, covered = open_at.pop(template)
            if 100 * covered >= self.covered * self.sizes[template]:
                found.append((self.labels[template], start, stop, covered, self.sizes[template]))

        for start, stop, state in matches:
            places: dict[int, list[int]] = {}
            for template, end in self.automaton.ends[state]:
                if template < len(self.sizes):
                    places.setdefault(template, []).append(end)
            for template, ends in places.items():
                chain = open_at.get(template)
                if chain:
                    for end in ends:
                        gain = min(end - chain[2], stop - max(start, chain[1]), stop - start)
                        if gain > 0 and end - gain - chain[2] <= self.gap and stop - gain - chain[1] <= self.gap:
                            chain[1:] = [stop, end, chain[3] + gain]
                            break
                    else:
                        close(template)
                        chain = None
                if not chain:
                    open_at[template] = [start, stop, ends[0], stop - start]
        for template in list(open_at):
            close(template)
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None,
             min_match: int = MIN_MATCH, gap: int = GAP, covered: int = COVERED) -> DataFrame:
    """One row per document: key, n_words, base (array of start, label), spans (array of label, start, stop, covered, size).

    Positions are numbers of words from 0, ``stop`` excluded; ``covered`` of the template's ``size`` words were met. A
    NULL or empty text has no words, base or spans. Repeated rows give repeated rows. Other columns are not read.
    ``templates``: (label, text) pairs, TEMPLATES if None; those without words are passed over.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, min_match, gap, covered)
    places = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    spans = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("covered", pa.int64()), ("size", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sizes, base, found = [], [], []
                for data in bytes_of(part.column(text)):
                    words = words_of(data)
                    a, b = scanner.scan(words)
                    sizes.append(len(words))
                    base.append([{"start": at, "label": label} for at, label in a])
                    found.append([dict(zip(("label", "start", "stop", "covered", "size"), s)) for s in b])
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(sizes, pa.int64()), pa.array(base, places), pa.array(found, spans)],
                                                 names=["key", "n_words", "base", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"key {kind}, n_words long, base array<struct<start:bigint,label:string>>, "
             "spans array<struct<label:string,start:bigint,stop:bigint,covered:bigint,size:bigint>>")
