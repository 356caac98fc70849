"""License scans by template-markup matching.

A template is a license text, or a notice, with markup:

* ``[ ... ]`` is an optional region: its words may stand there, all together, or not;
* ``{a-b}`` is a replaceable region: any ``a`` to ``b`` words (a name, a year).

All other words are mandatory wording and must stand in order, exactly. Texts and
templates are compared as words, runs of ``0-9``, ``a-z`` (after lower-casing
A-Z) and characters outside ASCII, so punctuation and layout do not matter.

All templates are compiled into one automaton over words: a state a word, with
the ways around optional regions and through replaceable ones already closed.
Its sets of states are bit masks, made deterministic as texts ask for them (a
bounded table of ``(mask, word) -> mask``). A scan begins at each word that can
begin a template and goes on while any state is left; prose leaves none after a
word or two. A template matches at a place up to its longest acceptance there,
and a match inside an earlier one of the same label is not reported again.

Defined results: a null or empty text has no words and no match; rows are kept
apart whatever their ids; an empty table gives none; columns other than the id
and the text do not matter. The work per word is bounded by the longest
template, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import encoded, slices

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
MARKS = re.compile(r"\[|\]|\{\d+-\d+\}|[^\[\]{}]+")
OUT = "doc_id long, n_words long, spans array<struct<label:string,start:long,end:long,base:boolean>>, score double"
SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
KEPT_STEPS = 200_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


# The phrases of the base rule and their labels.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

# The wording of public licenses and of their standard notices.
_AS_IS_BSD = """
THIS SOFTWARE IS PROVIDED BY {0-20} AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED IN NO EVENT SHALL {0-20} BE
LIABLE FOR ANY DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES INCLUDING BUT NOT LIMITED TO
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS INTERRUPTION HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING NEGLIGENCE OR OTHERWISE ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""
_BSD_HEAD = """
Redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met
[1] Redistributions of source code must retain the above copyright notice this list of conditions and the following
disclaimer
[2] Redistributions in binary form must reproduce the above copyright notice this list of conditions and the following
disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_NAME = """
[3] Neither the name of {0-20} nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission"""
_GNU = """[This program is free software] you can redistribute it and or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation"""

TEMPLATES = (
    Template("mit", """
Permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the Software to deal in the Software without restriction including without limitation the rights
to use copy modify merge publish distribute sublicense and or sell copies of the Software and to permit persons to
whom the Software is furnished to do so subject to the following conditions The above copyright notice and this
permission notice [including the next paragraph] shall be included in all copies or substantial portions of the
Software [THE SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT IN NO EVENT SHALL {0-20} BE
LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION OF CONTRACT TORT OR OTHERWISE ARISING FROM OUT OF
OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE]"""),
    Template("mit", "[is] [released] [distributed] [licensed] [available] under the [terms of the] [expat] mit license"),
    Template("isc", """
Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies [THE SOFTWARE IS PROVIDED AS
IS AND {0-12} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS]"""),
    Template("bsd-2", _BSD_HEAD + _AS_IS_BSD),
    Template("bsd-3", _BSD_HEAD + _BSD_NAME + _AS_IS_BSD),
    Template("zlib", """
This software is provided as is without any express or implied warranty In no event will the {0-6} be held liable for
any damages arising from the use of this software Permission is granted to anyone to use this software for any purpose
including commercial applications and to alter it and redistribute it freely"""),
    Template("unlicense", """
This is free and unencumbered software released into the public domain Anyone is free to copy modify publish use
compile sell or distribute this software"""),
    Template("bsl-1", """
[Distributed under the] Boost Software License Version 1 0"""),
    Template("apache-2", """
Licensed under the Apache License Version 2 0 [the License you may not use this file except in compliance with the
License You may obtain a copy of the License at {0-12} Unless required by applicable law or agreed to in writing
software distributed under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND
either express or implied]"""),
    Template("mpl-2", """
This Source Code Form is subject to the terms of the Mozilla Public License v 2 0 [If a copy of the MPL was not
distributed with this file You can obtain one at {0-6}]"""),
    Template("gpl-2", _GNU + " [either] version 2 of the License [or at your option any later version]"),
    Template("gpl-3", _GNU + " [either] version 3 of the License [or at your option any later version]"),
    Template("gpl-2", "[licensed] under the [terms of the] gnu general public license [gpl] version 2"),
    Template("gpl-3", "[licensed] under the [terms of the] gnu general public license [gpl] version 3"),
    Template("lgpl", "[licensed] under the [terms of the] gnu lesser general public license"),
    Template("agpl-3", "[licensed] under the [terms of the] gnu affero general public license"),
    Template("cc0", "[licensed] under [the] [creative commons] cc0 1 0 [universal]"),
    Template("cc-by", "licensed under [a] [the] creative commons attribution [2 0] [2 5] [3 0] [4 0] [international] license"),
    Template("cc-by", "licensed under cc by 2 0"),
    Template("cc-by", "licensed under cc by 2 5"),
    Template("cc-by", "licensed under cc by 3 0"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-sa", "licensed under [a] [the] creative commons attribution sharealike {0-3} license"),
    Template("cc-by-sa", "licensed under cc by sa"),
    Template("cc-by-nc", "licensed under [a] [the] creative commons attribution noncommercial {0-3} license"),
)


def template_words(text: str) -> list[bytes]:
    return WORDS.findall(text.encode().lower())


class Automaton:
    """All templates as one automaton over word numbers (0: a word of no template)."""

    def __init__(self, templates: Sequence[Template]) -> None:
        self.templates = list(templates)
        self.numbers: dict[bytes, int] = {}
        self._on: list[tuple[int | None, int]] = []  # of a state: its word (None: any) and the state after it
        self._empty: list[list[int]] = []  # ways without a word
        heads, self.accepts = [], {}
        for k, template in enumerate(self.templates):
            head, tail = self._compile(MARKS.findall(template.text))
            heads.append(head)
            self.accepts[tail] = k
        self.closed = [self._closure(s) for s in range(len(self._on))]
        self.start = 0
        for head in heads:
            self.start |= self.closed[head]
        self.accepting = sum(1 << s for s in self.accepts)
        if self.start & self.accepting:
            raise ValueError("a template accepts the empty text")
        self.by_word: dict[int, int] = {}  # states that a word leaves
        self.by_any = 0
        for s, (word, after) in enumerate(self._on):
            if after < 0:
                continue
            if word is None:
                self.by_any |= 1 << s
            else:
                self.by_word[word] = self.by_word.get(word, 0) | 1 << s
        self.steps: dict[tuple[int, int], int] = {}
        self.first = {w for w in range(len(self.numbers) + 1) if self.step(self.start, w)}

    def _state(self) -> int:
        self._on.append((None, -1))
        self._empty.append([])
        return len(self._on) - 1

    def _compile(self, marks: list[str]) -> tuple[int, int]:
        head = at = self._state()
        opened = []
        for mark in marks:
            if mark == "[":
                opened.append(at)
            elif mark == "]":
                self._empty[opened.pop()].append(at)
            elif mark[0] == "{":
                low, high = map(int, mark[1:-1].split("-"))
                skips = []
                for k in range(high):
                    if k >= low:
                        skips.append(at)
                    after = self._state()
                    self._on[at] = (None, after)
                    at = after
                # The region ends in a state of its own, as what follows must not leave from within it.
                end = self._state()
                for s in [*skips, at]:
                    self._empty[s].append(end)
                at = end
            else:
                for word in template_words(mark):
                    after = self._state()
                    self._on[at] = (self.numbers.setdefault(word, len(self.numbers) + 1), after)
                    at = after
            if mark in "[]":  # a state of its own, so a way around never meets the next region's
                after = self._state()
                self._empty[at].append(after)
                if mark == "[":
                    opened[-1] = at
                at = after
        if opened:
            raise ValueError("an optional region is not closed")
        return head, at

    def _closure(self, state: int) -> int:
        seen, todo = 1 << state, [state]
        while todo:
            for s in self._empty[todo.pop()]:
                if not seen >> s & 1:
                    seen |= 1 << s
                    todo.append(s)
        return seen

    def step(self, mask: int, word: int) -> int:
        after = self.steps.get((mask, word))
        if after is None:
            if len(self.steps) > KEPT_STEPS:
                self.steps.clear()
            left, after = mask & (self.by_word.get(word, 0) | self.by_any), 0
            while left:
                low = left & -left
                after |= self.closed[self._on[low.bit_length() - 1][1]]
                left ^= low
            self.steps[(mask, word)] = after
        return after

    def ended(self, mask: int) -> Iterator[int]:
        left = mask & self.accepting
        while left:
            low = left & -left
            yield self.accepts[low.bit_length() - 1]
            left ^= low

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int, bool]]:
        """``(label, start, end, base)`` of every match, by start."""
        get = self.numbers.get
        numbers = [get(w, 0) for w in words]
        found: list[tuple[str, int, int, bool]] = []
        reach: dict[tuple[str, bool], int] = {}
        for i in [i for i, w in enumerate(numbers) if w in self.first]:
            mask, j, longest = self.start, i, {}
            while mask and j < len(numbers):
                mask = self.step(mask, numbers[j])
                j += 1
                if mask & self.accepting:
                    longest.update((k, j) for k in self.ended(mask))
            for k, end in sorted(longest.items()):
                t = self.templates[k]
                if t.base or end > reach.get((t.label, False), 0):
                    found.append((t.label, i, end, t.base))
                    reach[(t.label, t.base)] = max(end, reach.get((t.label, t.base), 0))
        return found


def covered(spans: list[tuple[str, int, int, bool]]) -> int:
    """Words inside at least one span (spans by start)."""
    total = reach = 0
    for _, start, end, _ in spans:
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = BASE + TEMPLATES) -> DataFrame:
    """``doc_id, n_words, spans, score`` for each row of ``docs`` (``doc_id``,
    ``text``): the matches (label, first word, word after the last, whether of
    the base rule) and the share of the text's words that matches cover."""
    templates = tuple(templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(templates)
        for part in slices(batches):
            counts, spans, scores = [], [], []
            for text in encoded(part):
                words = WORDS.findall(text.lower())  # bytes: only A-Z change
                found = automaton.matches(words)
                counts.append(len(words))
                spans.append([dict(zip(("label", "start", "end", "base"), s)) for s in found])
                scores.append(covered(found) / len(words) if found else 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(SPAN)),
                 pa.array(scores, pa.float64())], names=["doc_id", "n_words", "spans", "score"])

    return docs.select("doc_id", "text").mapInArrow(scan, OUT)
