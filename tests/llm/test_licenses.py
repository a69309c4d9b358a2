import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks import compare
from tracklane.llm import licenses, queries

WORDS = ["a", "b", "c", "d"]


def pattern(markup):
    """The template as a regular expression over words that each end in a space."""
    out = ""
    for part in re.split(r"(<<.*?>>)", markup):
        if part == "<<beginOptional>>":
            out += "(?:"
        elif part == "<<endOptional>>":
            out += ")?"
        elif part.startswith("<<var"):
            low, high = re.findall(r"\d+", part)
            out += rf"(?:\S+ ){{{low},{high}}}"
        else:
            out += "".join(f"{w} " for w in part.split())
    return re.compile(r"(?<!\S)" + out)


TEMPLATES = [
    "a b", "a <<beginOptional>>b<<endOptional>> c", "a <<var;words=1-2>> d",
    "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> a<<endOptional>> d",
    "<<beginOptional>>b<<endOptional>> a <<var;words=0-3>> c <<var;words=2-2>> c",
    "a <<beginOptional>><<var;words=1-1>> b<<endOptional>> b",
]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(TEMPLATES), st.lists(st.sampled_from(WORDS), max_size=14))
def test_automaton_against_regular_expression(markup, words):
    template = licenses.Template(markup)
    text = "".join(f"{w} " for w in words)
    want = {m.start() for m in re.finditer(rf"(?={pattern(markup).pattern})", text)}
    found = template.matches(licenses.normalised(text))
    assert {start for start, _ in found} == want


@pytest.mark.parametrize("markup", ["", "<<var;words=1-2>> a", "<<beginOptional>>a<<endOptional>>"])
def test_templates_need_mandatory_words(markup):
    with pytest.raises(ValueError):
        licenses.Template(markup)


def test_whole_texts_and_places(spark):
    rows = [
        (1, "CC-BY, cc by\nAll Rights  reserved!", "x"),
        (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "all rights", "x"),
        (4, "w " * 300_000 + "Licensed under a Creative Commons CC BY-NC 4.0.", "x"),
        (5, "GNU General Public License as published by the Free Software Foundation; version 3", "x"),
        (6, "the GNU General Public License, revision 3", "x"),
        (7, "Copyright (c) 2020 Jane Doe and others. All rights reserved", "x"),
        (8, "Écc by cc by", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {(r.doc_id, r.n_words): r for r in licenses.scan(df).collect()}
    assert licenses.scan(df).count() == len(rows)

    def row(*key):
        r = got[key]
        return r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score

    assert row(1, 7) == (3, 0, 4, "cc-by,reserved", "cc-by,reserved", 0.5)
    assert row(2, 0) == row(3, 0) == row(None, 2) == (0, None, None, "", "", 0.0)
    assert row(4, 300_010) == (1, 300_005, 300_005, "cc-by", "cc-by,cc-by-nc-4.0", 1.0)
    assert row(5, 13) == (1, 1, 1, "gpl", "gpl,gpl-3.0", 1.0)
    assert row(6, 7) == (1, 2, 2, "gpl", "gpl", 0.5)
    assert row(7, 10) == (1, 7, 7, "reserved", "copyright,reserved", 1.0)
    assert row(8, 4)[:3] == (1, 2, 2)  # É is part of a word
    spans = {tuple(s) for s in got[(5, 13)].spans}
    assert ("gpl-3.0", 0, 13) in spans and ("gpl", 1, 3) in spans
    assert licenses.scan(df.where("false")).count() == 0


def test_query_against_sql(spark):
    con = compare.connect("/root/testdata/sf0.001")
    query, sql = queries.QUERIES["op2_licenses"], queries.SQL["op2_licenses"]
    ok, text = compare.compare(spark, con, query, sql, "/root/testdata/sf0.001")
    assert ok, text


MIT = """Copyright (c) 2018 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED “AS IS”, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NAMES = """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""


def test_only_whole_license_texts_are_licenses(spark):
    bsd_3 = BSD_2.replace("\nTHIS", f"{NAMES}\nTHIS")
    texts = {
        "mit": MIT, "bsd-2-clause": BSD_2, "bsd-3-clause": bsd_3, "bsd-2-clause,mit": MIT + BSD_2,
        "bsd-opening,mit": MIT + BSD_2[:200],
    }
    json = MIT.replace("THE SOFTWARE IS", "The Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS")
    changed = [
        (json, "mit-text"), (MIT.replace("OTHER DEALINGS", "DEALINGS"), "mit-text"),
        (MIT[: MIT.index("The above")], "mit-text"), (MIT.replace("sublicense", ""), "mit-text"),
        (BSD_2.replace("2. Redistributions", "2. All copies"), "bsd"),
        (bsd_3.replace("specific prior", "prior"), "bsd"), (BSD_2[:200], "bsd"),
    ]
    rows = [*texts.values(), *[text for text, _ in changed], "no license", None]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = [(r.text_labels, r.text_score) for r in licenses.scan(df).orderBy("doc_id").collect()]
    want = [(labels, 1.0) for labels in texts]
    want += [(f"{label}-opening", 0.25) for _, label in changed]
    assert got == [*want, ("", 0.0), ("", 0.0)]
