"""License scans by conditional compression.

Candidate blocks are the stretches of a text around words that every license wording has.  Each block
is compressed alone and with each template as a raw zstandard dictionary; a template that the block
repeats makes it much smaller.  Templates that save enough are confirmed word by word: the block must hold the
template's words in order but for a small share of differences, which are listed.  A confirmed stretch
is taken out and what is left of the block is tried again, so a block may hold several licenses.  A
block without a confirmed template is tried again in parts around each of its cues, where a short
declaration is not outweighed by the text beside it.  Licenses that begin alike are told apart by what
follows, and a stretch that a negation leads to declares nothing.

Null and empty texts and texts without a cue have no findings.  Case, spacing and punctuation do not
count as differences.  Whole texts are scanned, in blocks of bounded length that overlap by more than
the longest template.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Wordings that declare a license, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved. No part of this publication may be reproduced without permission."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("CC0-1.0", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
]

#: Words that tell one license from another; like numbers, none may be missing, replaced or added.
IDENTIFYING = frozenset(
    "apache mit bsd isc gnu general lesser library affero mozilla mpl eclipse cc creative commons attribution "
    "noncommercial non commercial sharealike share alike noderivatives noderivs derivatives derivs sa nc nd "
    "some boost zlib not never no nor neither cannot isn aren wasn weren doesn".split()
)

#: Clauses that tell a license from a shorter one that begins alike, the longest license first.
CLAUSES = {
    "BSD-2-Clause": [
        ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
        ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ],
}
#: Words behind a declaration in which a clause of it is looked for.
CLAUSE_REACH = 400
#: Words that take a declaration back when they lead to it, and how near they stand.
NEGATIONS = frozenset("not never no nor neither cannot isn aren wasn weren doesn longer".split())
NEGATION_REACH = 2

#: Every template holds one of these.
CUE = re.compile(r"licen[cs]e|permission|redistribut|public\s+domain|rights\s+reserved", re.I)

#: Characters of a block around a cue, and the longest block.
REACH, LONGEST_BLOCK = 160, 4096
#: Share of a template's words that may differ.
DIFFERENT = 0.12
#: Words to either side of a cue in the smallest part of a block that is tried alone.
SHORTEST_PART = 12
#: Part of a block's compressed size per template byte that a template must save to be tried.
LEAST_SAVED = 0.15

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


class Template:
    def __init__(self, name: str, text: str):
        import zstandard

        self.name, self.words = name, [w.lower() for w in _WORD.findall(text)]
        content = " ".join(self.words).encode()
        self.size = len(content)
        dictionary = zstandard.ZstdCompressionDict(
            content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.compress = zstandard.ZstdCompressor(level=3, dict_data=dictionary).compress


@functools.cache
def _templates() -> tuple[list[Template], object]:
    import zstandard

    return [Template(*t) for t in TEMPLATES], zstandard.ZstdCompressor(level=3).compress


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans around cues; overlapping ones are one, cut where it is too long, with an overlap."""
    spans: list[list[int]] = []
    for cue in CUE.finditer(text):
        low, high = max(0, cue.start() - REACH), min(len(text), cue.end() + REACH)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    for low, high in spans:
        step = LONGEST_BLOCK // 2
        for start in range(low, max(low + 1, high - step), step):
            yield start, min(high, start + LONGEST_BLOCK)


def ranked(words: list[str]) -> list[tuple[int, Template]]:
    """Templates by the bytes that each saves as a dictionary, the most first."""
    templates, alone = _templates()
    data = " ".join(words).encode()
    size = len(alone(data))
    saved = [(size - len(t.compress(data)), t) for t in templates]
    worth = [(n, t) for n, t in saved if n >= LEAST_SAVED * min(t.size, size)]
    return sorted(worth, key=lambda s: -s[0])


def confirm(words: list[str], template: Template) -> tuple[int, int, list[str]] | None:
    """The stretch of ``words`` that the template covers and its differences, or none.

    Numbers tell versions apart and some words licenses, so none of these may differ.
    """
    wanted = template.words
    core = SequenceMatcher(None, wanted, words, autojunk=False).find_longest_match()
    if core.size < min(3, len(wanted)):
        return None
    allowed = int(DIFFERENT * len(wanted))
    low = max(0, core.b - core.a - allowed)
    high = min(len(words), core.b + len(wanted) - core.a + allowed)
    ops = SequenceMatcher(None, wanted, words[low:high], autojunk=False).get_opcodes()
    kept = [op for op in ops if op[0] == "equal"]
    first, last = low + kept[0][3], low + kept[-1][4]
    differences, changed_words = [], set()
    for kind, a, b, c, d in ops:
        # Words of the block before and after the template are no differences.
        extra = words[low:high][c:d] if first - low <= c < last - low else []
        if kind != "equal" and (wanted[a:b] or extra):
            differences.append(f"{' '.join(wanted[a:b])} -> {' '.join(extra)}")
            changed_words.update(wanted[a:b], extra)
    changed = sum(max(b - a, d - c if first - low <= c < last - low else 0) for k, a, b, c, d in ops if k != "equal")
    other = any(w in IDENTIFYING or any(map(str.isdigit, w)) for w in changed_words)
    return (first, last, differences) if changed <= allowed and not other else None


def _negated(text: str, start: int) -> bool:
    """Whether the words just before, in the same sentence, take the declaration back."""
    before = re.split(r"[.;:!?]\s|\n\s*\n", text[max(0, start - 64) : start])[-1]
    # "isn't" falls into two words, of which the second is one letter.
    words = [w.lower() for w in _WORD.findall(before) if len(w) > 1]
    return not NEGATIONS.isdisjoint(words[-NEGATION_REACH:])


def _told_apart(text: str, finding: dict) -> dict:
    """The finding as that of the longer license, if a clause of it follows; it then ends behind the clause."""
    for name, clause in CLAUSES.get(finding["license"], ()):
        if finding["end"] - finding["start"] < len(clause):
            continue  # a license that is called by name has no clauses
        wanted = [w.lower() for w in _WORD.findall(clause)]
        words, at = [], 0
        for word in itertools.islice(_WORD.finditer(text, finding["end"]), CLAUSE_REACH):
            words.append(word[0].lower())
            at = word.end()
            if words[-len(wanted) :] == wanted:
                return {**finding, "license": name, "end": at}
    return finding


def _parts(
    places: list[tuple[int, int]], a: int, b: int, cues: list[int]
) -> Iterator[tuple[int, int]]:
    """Stretches of the words ``a`` to ``b`` around each cue, by the lengths that templates have."""
    ends = [end for _, end in places]
    longest = max(len(t.words) for t in _templates()[0])
    for cue in cues:
        at = bisect.bisect_right(ends, cue)
        if not a <= at < b:
            continue
        reach = SHORTEST_PART
        while reach < longest * 2:
            part = max(a, at - reach), min(b, at + reach)
            if part == (a, b):
                break
            yield part
            reach *= 2


def scan(text: str | None) -> list[dict]:
    """``license, start, end, saved, differences`` of each declaration, in order of place."""
    found: dict[tuple[int, int], dict] = {}
    barren: set[tuple[str, ...]] = set()  # wordings that were tried and hold nothing
    for low, high in blocks(text or ""):
        places = [(m.start() + low, m.end() + low) for m in _WORD.finditer(text[low:high])]
        cues = [m.start() + low for m in CUE.finditer(text[low:high])]
        waiting = [(0, len(places), True)]
        while waiting:
            a, b, whole = waiting.pop()
            words = [text[s:e].lower() for s, e in places[a:b]]
            if not whole and tuple(words) in barren:
                continue
            best = None
            for saved, template in ranked(words) if words else ():
                span = confirm(words, template)
                key = span and (-(span[1] - span[0]), len(span[2]), -saved)
                if span and (best is None or key < best[0]):
                    best = key, saved, template, span
            if best is None:
                barren.add(tuple(words))
                if whole:
                    waiting += [(c, d, False) for c, d in _parts(places, a, b, cues)]
                continue
            _, saved, template, (first, last, differences) = best
            start, end = places[a + first][0], places[a + last - 1][1]
            finding = {
                "license": template.name, "start": start, "end": end, "saved": saved,
                "differences": differences,
            }
            if not _negated(text, start):
                finding = _told_apart(text, finding)
                found[start, finding["end"]] = finding
            waiting += [(a, a + first, whole), (a + last, b, whole)]
    spans = sorted(found, key=lambda s: (s[0], -s[1]))
    out, reached = [], -1
    for span in spans:
        if span[1] > reached:  # blocks overlap: the longest finding at a place counts
            out.append(found[span])
            reached = span[1]
    return out


FINDINGS = (
    "array<struct<license: string, start: int, end: int, saved: int, differences: array<string>>>"
)


def license_findings(text: Column | str) -> Column:
    """The findings of a text as an array, empty where there are none."""
    kind = pa.list_(
        pa.struct(
            [
                ("license", pa.string()),
                ("start", pa.int32()),
                ("end", pa.int32()),
                ("saved", pa.int32()),
                ("differences", pa.list_(pa.string())),
            ]
        )
    )

    @F.arrow_udf(FINDINGS)
    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([scan(t.as_py()) for t in texts], kind)

    return scanned(text)
