"""Licence statements in texts: phrases, and templates with optional and replaceable parts.

Templates are written in markup: `<<beginOptional>> ... <<endOptional>>` may be missing,
`<<any:a-b>>` stands for a to b words, `<<one:x|y z>>` for one of the alternatives, the empty
one too. The licences of few words are there with all their mandatory wording, from the grant to
the end of the disclaimer, so a text that has the beginning alone holds none. Each template is
compiled to an automaton over words; a text holds the licence where the automaton accepts,
which takes every mandatory word in order and nothing else between them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstats.llm.common import by_batch

# Base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:
<<one:1|a|>> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.
<<one:2|b|>> Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. """
_BSD_NAMES = """<<one:3|c|>> Neither the name of <<any:1-12>> nor the names of <<one:its|any>>
<<beginOptional>>other<<endOptional>> contributors may be used to endorse or promote products
derived from this software without specific prior written permission. """
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<any:1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS
FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any:1-12>> BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""

# Whole licences and well-known notices, with their labels.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<any:1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE""",
    "bsd-2-clause": _BSD_GRANT + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER,
    "isc": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute
this software for any purpose with or without fee is hereby granted, provided that the above copyright
notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
<<any:1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any:1-12>> BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:
<<one:1|>> The origin of this software must not be misrepresented; you must not claim that you wrote
the original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required. <<one:2|>> Altered source versions must be
plainly marked as such, and must not be misrepresented as being the original software. <<one:3|>>
This notice may not be removed or altered from any source distribution""",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may
not use this file except in compliance with the License. You may obtain a copy of the License at
<<any:3-8>> Unless required by applicable law or agreed to in writing, software distributed under
the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations
under the License""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License,
v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at""",
    "gpl-2.0-or-later": """<<any:1-12>> is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License as published by the Free Software Foundation;
either version 2 <<beginOptional>>of the License<<endOptional>>, or (at your option) any later
version""",
    "gpl-3.0-or-later": """<<any:1-12>> is free software: you can redistribute it and/or modify it
under the terms of the GNU General Public License as published by the Free Software Foundation,
either version 3 <<beginOptional>>of the License<<endOptional>>, or (at your option) any later
version""",
    "cc0-1.0": """<<one:released|dedicated|distributed|available|licensed>> under
<<beginOptional>>the<<endOptional>> <<one:CC0|CC0 1.0|Creative Commons Zero|CC0 1.0 Universal>>""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone
is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means""",
    "apache-2.0": "licensed under the <<beginOptional>>terms of the<<endOptional>> Apache"
    " License <<beginOptional>>,<<endOptional>> Version 2.0",
    "mit": "<<one:released|licensed|distributed|available|provided>> under the"
    " <<beginOptional>>terms of the<<endOptional>> MIT License",
    "gpl-3.0": "<<one:work|program|software|library|file>> is licensed under the"
    " <<beginOptional>>terms of the<<endOptional>> GNU General Public License"
    " <<beginOptional>>as published by the Free Software Foundation<<endOptional>> version 3"
    " <<beginOptional>>of the license<<endOptional>>",
    "cc-by-4.0": "licensed under <<beginOptional>>a<<endOptional>>"
    " <<one:CC BY|Creative Commons Attribution>> 4.0",
    "cc-by-sa-4.0": "licensed under <<beginOptional>>a<<endOptional>>"
    " <<one:CC BY-SA|Creative Commons Attribution-ShareAlike>> 4.0",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a<<endOptional>>"
    " <<one:CC BY-NC|Creative Commons Attribution-NonCommercial>> 4.0",
}

#: Lower-cases A to Z; every other byte that no word has becomes a space.
TO_WORDS = bytes(
    b + 32
    if 0x41 <= b <= 0x5A
    else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of letters a to z, digits and characters past ASCII, A to Z lower-cased."""
    return text.encode().translate(TO_WORDS).split()


class Automaton:
    """States of a template: from each, the next by word, by any word, or by none."""

    def __init__(self, markup: str):
        self.by_word: list[dict[bytes, set[int]]] = [{}]
        self.by_any: list[set[int]] = [set()]
        self.free: list[set[int]] = [set()]
        # Leading words before the first mandatory run, at most, and that run.
        self.lead, self.anchor = 0, []
        runs: list[tuple[int, list[bytes]]] = []
        most, depth, state, opened, fresh = 0, 0, 0, [], True
        for part in re.split(r"(<<.*?>>)", markup):
            if part == "<<beginOptional>>":
                opened.append(state)
                depth, fresh = depth + 1, True
            elif part == "<<endOptional>>":
                end = self._state()
                self.free[state].add(end)
                self.free[opened.pop()].add(end)
                state, depth, fresh = end, depth - 1, True
            elif part.startswith("<<any:"):
                low, high = map(int, part[6:-2].split("-"))
                end = self._state()
                for n in range(high):
                    if n >= low:
                        self.free[state].add(end)
                    after = self._state()
                    self.by_any[state].add(after)
                    state = after
                self.free[state].add(end)
                state, most, fresh = end, most + high, True
            elif part.startswith("<<one:"):
                end, choices = self._state(), [words_of(x) for x in part[6:-2].split("|")]
                for choice in choices:
                    self.free[self._words(state, choice)].add(end)
                state, most, fresh = end, most + max(map(len, choices)), True
            elif found := words_of(part):
                state = self._words(state, found)
                if not depth:
                    if fresh:
                        runs.append((most, []))
                    runs[-1][1].extend(found)
                    fresh = False
                most += len(found)
        self.end = state
        # The longest run of mandatory words tells where to try.
        self.lead, self.anchor = max(runs, key=lambda run: len(run[1]))

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(set())
        self.free.append(set())
        return len(self.by_word) - 1

    def _words(self, state: int, words: list[bytes]) -> int:
        for word in words:
            after = self._state()
            self.by_word[state].setdefault(word, set()).add(after)
            state = after
        return state

    def _freely(self, states: set[int]) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for after in self.free[todo.pop()] - found:
                found.add(after)
                todo.append(after)
        return found

    def accepts(self, words: list[bytes], start: int) -> int | None:
        """Where the longest accepted wording that begins at `start` ends."""
        states, at, accepted = self._freely({0}), start, None
        while states:
            if self.end in states:
                accepted = at
            if at == len(words):
                break
            after = set().union(*(self.by_word[s].get(words[at], ()) for s in states))
            after.update(*(self.by_any[s] for s in states))
            states, at = self._freely(after), at + 1
        return accepted


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Offsets of the space before each occurrence of whole words in words joined by spaces."""
    found, at = [], joined.find(phrase)
    while at >= 0:
        found.append(at)
        at = joined.find(phrase, at + 1)
    return found


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(b" " + b" ".join(words_of(k)) + b" ", v) for k, v in phrases.items()]
        self.templates = [
            (b" " + b" ".join(a.anchor) + b" ", a, label)
            for label, a in ((k, Automaton(v)) for k, v in templates.items())
        ]

    def scan(self, text: str) -> dict:
        words = words_of(text)
        joined = b" ".join([b"", *words, b""])
        base = [(at, label) for phrase, label in self.phrases for at in places(joined, phrase)]
        tries = [(at, a, label) for p, a, label in self.templates for at in places(joined, p)]
        starts, spans = [], []
        if base or tries:
            spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20).tolist()
            starts = [bisect_left(spaces, at) for at, _ in base]
            for at, automaton, label in tries:
                first = bisect_right(spaces, at) - 1
                for start in range(max(0, first - automaton.lead), first + 1):
                    end = automaton.accepts(words, start)
                    if end is not None and end > first:
                        spans.append((label, start, end))
                        break
        base_labels = {label for _, label in base}
        labels = {label for label, _, _ in spans}
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | labels)),
            "score": 1.0 if spans else 0.5 if base else 0.0,
            "spans": [{"label": x, "start": s, "end": e} for x, s, e in sorted(set(spans))],
        }


LICENCES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)


def scan_licences(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
    text: str = "text",
) -> DataFrame:
    """Phrases and templates found in every whole text, and where (words from 0).

    `score` is 1 where a template's mandatory wording stands, 0.5 with phrases alone, else 0.
    A null text counts as empty: no words, no labels. Rows are independent of one another, so
    repeated rows repeat; a null doc_id is carried through; further columns are ignored.
    """
    phrases, templates = phrases or PHRASES, TEMPLATES if templates is None else templates

    def make():
        scanner = Scanner(phrases, templates)

        def columns(batch):
            rows = [scanner.scan(x.as_py() or "") for x in batch.column(1)]
            found = {f.name: [r[f.name] for r in rows] for f in LICENCES.fields[1:]}
            return {"doc_id": batch.column(0), **found}

        return columns

    return by_batch(docs.select(F.col("doc_id").cast("long"), text), make, LICENCES)
