from __future__ import annotations

import pytest

from eddyline.llm import licenses
from eddyline.llm.licenses import TEMPLATES, scan

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_each_template_is_found_as_itself(name, text):
    for page in (text, f"Some words before. {text}\nAnd some after it.", text.upper().replace(" ", "\n")):
        (found,) = scan(page)
        assert found["license"] == name and found["differences"] == []
        assert found["end"] - found["start"] >= 0.95 * len(text.rstrip(".,"))


def test_differences_are_listed_and_bounded():
    text = TEMPLATES[1][1]
    (found,) = scan(text.replace("file", "module", 1))
    assert found["license"] == "Apache-2.0" and found["differences"] == ["file -> module"]
    assert all(f["license"] != "MIT" for f in scan(TEMPLATES[3][1][:200]))


@pytest.mark.parametrize(
    "text",
    [
        None, "", "no cue at all " * 1000, "the license of this driver", "permission " * 3000,
        "Licensed under CC BY 3.0.", "This work is licensed under the GNU General Public License, version 1.",
    ],
)
def test_others_are_not_found(text):
    assert scan(text) == []


def test_several_in_one_text():
    several = [TEMPLATES[k] for k in (0, 3, 7, 11, 15, 2)]
    text = "\n".join(t for _, t in several)
    assert [f["license"] for f in scan(text)] == [n for n, _ in several]
    long = ("filler words " * 400).join(t for _, t in several)
    assert [f["license"] for f in scan(long)] == [n for n, _ in several]


#: Legal text that echoes long templates and declares nothing.
REWORDED = (
    "Permission is given hereby, at no charge, to any person who obtains copies of this software and the "
    'associated documentation files (the "Software"), to deal in the Software without limits, including '
    "without limitation rights to use, copy, alter, merge, publish, give out, sublicense, and sell copies of "
    "the Software, subject to these conditions: the copyright notice above and this permission notice shall "
    "be included with all copies or large portions of the Software. Redistribution and use in source and "
    "binary form, changed or not, is permitted provided these conditions are met. You can redistribute this "
    "program and modify it under the GNU General Public License as the Free Software Foundation published "
    "it, or any later version. "
)


@pytest.mark.parametrize("name, text", [t for t in TEMPLATES if len(t[1]) < 100])
def test_short_declarations_beside_reworded_text(name, text):
    assert scan(REWORDED) == []
    for page in (REWORDED + text, f"{text} {REWORDED}", f"{REWORDED}{text} {REWORDED}"):
        assert [(f["license"], f["differences"]) for f in scan(page)] == [(name, [])]


CC = "This work is licensed under a Creative Commons {} 4.0 International License."


@pytest.mark.parametrize(
    "text, name",
    [
        (CC.format("Attribution-ShareAlike"), "CC-BY-SA-4.0"),
        (CC.format("Attribution-NoDerivatives"), "CC-BY-ND-4.0"),
        (CC.format("Attribution-NonCommercial-ShareAlike"), "CC-BY-NC-SA-4.0"),
        (CC.format("Attribution-NonCommercial-NoDerivatives"), "CC-BY-NC-ND-4.0"),
        (CC.format("Sampling"), None),
        ("This work is licensed under the GNU Lesser General Public License, version 2.", None),
        ("This work is licensed under the GNU Library General Public License, version 2.", None),
        (TEMPLATES[8][1].replace("GNU", "GNU Affero"), None),
        (TEMPLATES[12][1].replace("Mozilla", "Eclipse").replace("MPL", "EPL").replace("mozilla", "eclipse"), None),
        (TEMPLATES[6][1].replace("any purpose", "any non-commercial purpose"), None),
    ],
)
def test_identifying_words_are_no_wording_differences(text, name):
    assert [f["license"] for f in scan(text)] == ([name] if name else [])


BSD = TEMPLATES[4][1] + (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
AS_IS = ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS WARRANTIES ARE DISCLAIMED.'


def test_licenses_that_begin_alike():
    assert [f["license"] for f in scan(BSD + AS_IS)] == ["BSD-2-Clause"]
    (found,) = scan(BSD + THIRD + AS_IS)
    assert found["license"] == "BSD-3-Clause" and (BSD + THIRD + AS_IS)[: found["end"]].endswith("written permission")
    advertising = " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: x."
    assert [f["license"] for f in scan(BSD + advertising + THIRD + AS_IS)] == ["BSD-4-Clause"]
    # Each text of two has its own.
    assert [f["license"] for f in scan(BSD + THIRD + "\n" * 5 + BSD + AS_IS)] == ["BSD-3-Clause", "BSD-2-Clause"]


@pytest.mark.parametrize(
    "text, name",
    [
        ("This work is not licensed under the GNU General Public License, version 3.", None),
        ("It is not licensed under CC BY 4.0.", None),
        ("It is no longer released under the MIT License.", None),
        ("It isn't distributed under the Boost Software License, Version 1.0.", None),
        ("This is no draft. Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("You may not copy it. It is released under the MIT License.", "MIT"),
        ("Not mine\n\nReleased under the MIT License.", "MIT"),
    ],
)
def test_a_negated_declaration_is_none(text, name):
    assert [f["license"] for f in scan(text)] == ([name] if name else [])


def exact(text):
    """License and end of every template that stands in a text word for word, by plain search."""
    words = [(m[0].lower(), m.end(), m.start()) for m in licenses._WORD.finditer(text or "")]
    plain = [w for w, _, _ in words]

    def negated(k):
        """One of the two words before, without an end of a sentence in between."""
        near = [end for word, end, _ in words[max(0, k - 2) : k] if word in NOT]
        return any(not set(".;:!?") & set(text[end : words[k][2]]) for end in near)
    out = set()
    for name, template in TEMPLATES:
        wanted = [w.lower() for w in licenses._WORD.findall(template)]
        for k in range(len(plain) - len(wanted) + 1):
            if plain[k : k + len(wanted)] == wanted and not negated(k):
                out.add((name, words[k + len(wanted) - 1][1]))
    return out


NOT = {"not", "never", "no", "longer"}


def test_every_exact_wording_is_found(spark):
    """Documents, and each template between two of them, against plain search."""
    docs = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    planted = [f"{docs[k][:3000]}\n{t} {docs[k + 1][:3000]}" for k, (_, t) in enumerate(TEMPLATES)]
    seen = 0
    for text in docs + planted:
        want = exact(text)
        got = {(f["license"], f["end"]) for f in scan(text) if not f["differences"]}
        # A short declaration inside a longer one is that one.
        assert got <= want and all(any(end <= e for _, e in got) for _, end in want)
        seen += len(got)
    assert seen > len(TEMPLATES)


def test_query(spark):
    from eddyline.llm.queries import op9_licenses

    found = {(r.doc_id, r.license, r.start, r.end) for r in op9_licenses(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    slow = {(d.doc_id, f["license"], f["start"], f["end"]) for d in docs for f in scan(d.text)}
    assert found == slow
    plain = {d.doc_id for d in docs if "Apache License, Version 2.0" in (d.text or "")}
    assert plain == {k for k, name, _, _ in found if name == "Apache-2.0"}
    none = spark.createDataFrame([(None, "x")], "text string, license string")
    assert none.select(licenses.license_findings("text")).collect()[0][0] == []
