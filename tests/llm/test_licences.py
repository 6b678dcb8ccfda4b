import pytest
from test_words import split

from tablesync.llm.licences import TEMPLATES, scan_licences

SCHEMA = "doc_id long, text string, best int, dice string"
MIT = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 200)


def grams(text):
    w = split(text)
    return set(zip(w, w[1:], strict=False))


def brute(text, threshold=0.8, templates=TEMPLATES):
    import re

    found = {}
    units = [] if text is None else [*text.split("\n"), *re.split(r"\n[ \t]*\n", text), text]
    for unit in units:
        for name, body in templates:
            a, b = grams(unit), grams(body or "")
            if a and b and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                found[name] = max(found.get(name, 0), 2 * len(a & b) / (len(a) + len(b)))
    best = min(found, key=lambda n: (-found[n], n), default=None)
    return len(found), ",".join(sorted(found)), best, found.get(best)


TEXTS = [
    None, "", "x", "Released under the MIT License.", "Prose before.\nreleased UNDER the mit-license!\nprose after", "Released under the MIT License, 2024",
    "Released under the Mit Licence.", "one\n\n" + MIT.replace(", ", ",\n") + "\n \t\nLicensed under CC BY-NC 4.0.\nend", MIT.replace("Software", "Work", 2),
    MIT, "Licensed under CC BY 4.0.\r\nLicensed under CC BY-NC 4.0.", "a b " * 100_000 + "\nLicensed under the Apache License, Version 2.0.", "\n\n\n",
    "This work is licensed under the GNU General Public License, version 3. And more words follow on the same line here.",
]


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_against_every_template(rows, threshold):
    docs = [(i, t, 0, "") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 0, ""), (None, TEXTS[9], 0, "")]
    got = scan_licences(rows(docs, SCHEMA), threshold=threshold).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *brute(t, threshold)) for i, t, *_ in docs), key=str)


def test_other_templates_and_no_documents(rows):
    own = [("short", "two words"), ("none", "word"), ("null", None), ("tie", "Two words")]
    docs = rows([(1, "two words\nword", 0, "")], SCHEMA)
    assert tuple(scan_licences(docs, templates=own).first()) == (1, 2, "short,tie", "short", 1.0)
    assert tuple(scan_licences(docs, templates=[]).first()) == (1, 0, "", None, None)
    assert scan_licences(rows([], SCHEMA)).count() == 0


GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""


def brute_runs(text):
    """Every run of neighbouring lines."""
    lines = text.split("\n")
    found = {}
    for name, body in TEMPLATES:
        b = grams(body)
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                a = grams("\n".join(lines[i:j]))
                dice = 2 * len(a & b) / (len(a) + len(b))
                if dice >= 0.8:
                    found[name] = max(found.get(name, 0), dice)
    best = min(found, key=lambda n: (-found[n], n), default=None)
    return len(found), ",".join(sorted(found)), best, found.get(best)


def test_published_notices_inside_longer_documents(rows):
    prose = [" ".join(f"w{n}{k}" for k in range(10)) for n in range(30)]
    around = lambda notice: "\n".join([*prose[:4], "", notice, "", *prose[4:]])
    unwrapped = "\n\n".join(" ".join(p.split()) for p in GPL.split("\n\n"))
    commented = "\n".join("# " + line.strip() for line in GPL.split("\n"))
    texts = [
        GPL, around(GPL), around(unwrapped), around(commented), around(APACHE), around("\n\n".join([GPL] * 3)), around(GPL.replace("\n", "\r\n")),
        around("Released under\nthe MIT License."), around("This program is free software\n" * 40 + GPL),
    ]
    got = {r[0]: tuple(r[1:]) for r in scan_licences(rows(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_runs(text), i
        assert got[i][0] == 1
