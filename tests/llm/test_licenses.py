"""Base phrases beside a plain version; rules, priority and containment."""

import random
import re

import pytest

from ballotlake.llm import common
from ballotlake.llm import licenses as L


def plain(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in L.BASE.items():
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k:k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_given_documents(spark, sf):
    rows = {r.doc_id: r for r in L.query(spark, sf).collect()}
    for r in common.table(spark, sf, "documents").collect():
        got = rows[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word, got.base_labels) == plain(r.text)
        assert set(filter(None, got.base_labels.split(","))) <= set(filter(None, got.labels.split(",")))
        assert 0 <= got.score <= 1 and (got.score > 0) == (got.labels != "")


def test_random_texts():
    dice = random.Random(2)
    parts = ["under", "the", "MIT", "license", "Apache", "version", "2", "cc", "by", "nc", "é", "cc-by-nc", "under the mit license", "license,", "2.0"]
    for _ in range(3000):
        text = "".join(dice.choice(parts) + dice.choice([" ", "-", "\n", ""]) for _ in range(dice.randint(0, 25)))
        assert L.scan(text.encode())[:5] == plain(text), text


@pytest.mark.parametrize("text, labels", [
    ("SPDX-License-Identifier: GPL-2.0", "gpl-2"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("GNU Lesser General Public License v2.1 applies", "lgpl-2.1"),
    ("Released under the GNU Affero General Public License", "agpl"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "cc-by-nc-sa-4.0"),
    ("dual licensed under the Mozilla Public License 2.0 or the Apache License 2.0", "apache-2,mpl-2"),
    ("3-clause BSD license", "bsd-3-clause"),
    ("All rights reserved.", "all-rights-reserved"),
    ("the cost of licenses rose, and by the way a miter saw", ""),
])
def test_rules(text, labels):
    assert L.scan(text.encode())[5] == labels


# family: SPDX identifier, its label, a full name
NAMES = {
    "apache": ("Apache-2.0", "apache-2", "Apache License"), "agpl": ("AGPL-3.0-only", "agpl-3", "GNU Affero General Public License"),
    "lgpl": ("LGPL-2.1-or-later", "lgpl-2.1", "GNU Lesser General Public License"), "gpl": ("GPL-3.0-only", "gpl-3", "GNU General Public License"),
    "gfdl": ("GFDL-1.3", "gfdl-1.3", "GNU Free Documentation License"), "mpl": ("MPL-2.0", "mpl-2", "Mozilla Public License"),
    "epl": ("EPL-2.0", "epl-2", "Eclipse Public License"), "cddl": ("CDDL-1.1", "cddl-1.1", "Common Development and Distribution License"),
    "cpl": ("CPL-1.0", "cpl-1", "Common Public License"), "eupl": ("EUPL-1.2", "eupl-1.2", "European Union Public Licence"),
    "artistic": ("Artistic-2.0", "artistic-2", "Artistic License"), "boost": ("BSL-1.0", "boost-1", "Boost Software License"),
    "ofl": ("OFL-1.1", "ofl-1.1", "SIL Open Font License"), "osl": ("OSL-3.0", "osl-3", "Open Software License"),
    "afl": ("AFL-3.0", "afl-3", "Academic Free License"), "cecill": ("CECILL-2.1", "cecill-2.1", "CeCILL"),
    "zpl": ("ZPL-2.1", "zpl-2.1", "Zope Public License"), "php": ("PHP-3.01", "php-3.01", "PHP License"),
    "python": ("PSF-2.0", "python-2", "Python Software Foundation License"), "odbl": ("ODbL-1.0", "odbl-1", "Open Database License"),
    "cdla": ("CDLA-Permissive-2.0", "cdla-2", "Community Data License Agreement Permissive"), "mit": ("MIT", "mit", "MIT License"),
    "mit-0": ("MIT-0", "mit-0", "MIT No Attribution License"), "isc": ("ISC", "isc", "ISC License"), "zlib": ("Zlib", "zlib", "zlib License"),
    "bsd-4-clause": ("BSD-4-Clause", "bsd-4-clause", "Original BSD License"), "bsd-3-clause": ("BSD-3-Clause", "bsd-3-clause", "New BSD License"),
    "bsd-2-clause": ("BSD-2-Clause", "bsd-2-clause", "Simplified BSD License"), "0bsd": ("0BSD", "0bsd", "Zero-Clause BSD License"),
    "bsd": ("BSD", "bsd", "BSD License"), "unlicense": ("Unlicense", "unlicense", "The Unlicense"), "wtfpl": ("WTFPL", "wtfpl", "WTFPL"),
    "ms-pl": ("MS-PL", "ms-pl", "Microsoft Public License"), "ms-rl": ("MS-RL", "ms-rl", "Microsoft Reciprocal License"),
    "postgresql": ("PostgreSQL", "postgresql", "PostgreSQL License"), "openssl": ("OpenSSL", "openssl", "OpenSSL License"),
    "ncsa": ("NCSA", "ncsa", "University of Illinois/NCSA Open Source License"), "x11": ("X11", "x11", "X11 License"),
    "pddl": ("PDDL-1.0", "pddl", "Public Domain Dedication and License"), "odc-by": ("ODC-By-1.0", "odc-by", "Open Data Commons Attribution License"),
}


@pytest.mark.parametrize("family", [family[0] for family in L.FAMILIES])
def test_every_family_in_every_form(family):
    spdx, label, name = NAMES[family]
    for form in ("SPDX-License-Identifier: {}", "It is licensed under {}.", "Released under the {}", "License: {}", "{}-licensed code",
                 "SPDX-License-Identifier: (JSON OR {})", "licensed under JSON or {}"):
        assert L.scan(form.format(spdx).encode())[5] == label, form.format(spdx)
    for form in ("SPDX-License-Identifier: {}", "Distributed under the terms of the {}", "subject to the {}", "{} text", "see the {}"):
        assert L.scan(form.format(name).encode())[5] == family, form.format(name)


@pytest.mark.parametrize("text", [
    "An Apache helicopter landed", "the Apache 2.4 server", "Apache 2.0 was slow", "scored in the EPL", "EPL 2-0", "an AFL final", "mpl and osl",
    "he went home mit dem Hut", "php 3 and zlib", "available under X11", "boost 1 file", "Apache file", "MIT engineers",
])
def test_names_of_other_things(text):
    assert L.scan(text.encode())[5:7] == ("", 0.0)


@pytest.mark.parametrize("text, labels", [
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2,mit"), ("license = MIT/Apache-2.0", "apache-2,mit"),
    ("Licensed under the Apache 2.0 license", "apache-2"), ("MIT-licensed", "mit"), ("licensed under MIT", "mit"), ("under Apache 2.4", ""),
])
def test_short_statements(text, labels):
    assert L.scan(text.encode())[5] == labels


def test_containment_and_hundreds_of_rules():
    assert len(L.rules()) > 300
    spans = L.scan(b"licensed under the apache license, version 2.0")[7]
    assert spans == "apache-2:0:8"
    far = "apache license version 2 " + "filler " * 60_000 + "mit license"
    assert L.scan(far.encode())[5] == "apache-2,mit"


def plain_labels(text):
    """Every rule over the whole text, and every detection beside every other."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    body = " ".join(words).encode()
    found = {}
    for rule in L.rules():
        if any(keyword in body for keyword in rule.keywords):
            for m in rule.regex.finditer(body):
                start, end = m.span(rule.part)
                found[rule.priority, start - end, start, rule.label] = (start, end, rule.label)
    taken = []
    for _, (start, end, label) in sorted(found.items()):
        if not any(low <= start and end <= high for low, high, _ in taken):
            taken.append((start, end, label))
    return ",".join(f"{label}:{a}:{b}" for a, b, label in sorted(
        (body.count(b" ", 0, start), body.count(b" ", 0, start) + 1 + body.count(b" ", start, end), label) for start, end, label in taken))


def test_labels_and_suppression_against_a_plain_version():
    dice = random.Random(4)
    parts = [name for names in NAMES.values() for name in names] + [
        "SPDX-License-Identifier:", "licensed under the", "under", "the", "terms of", "released", "license", "licence is", "or", "and", "with", "version",
        "2.0", "3", "public domain", "copyright 2020", "cc by nc sa 4.0", "Creative Commons Attribution", "all rights reserved", "word", "text", "LicenseRef-a-b"]
    for k in range(400):
        text = " ".join(dice.choice(parts) for _ in range(dice.randint(0, 40 if k % 8 else 300)))
        if k % 3 == 0:
            text = text.replace(" word ", " " + "filler " * 60)
        assert L.scan(text.encode())[7] == plain_labels(text), text


@pytest.mark.parametrize("count", [2, 3, 4, 12, 200])
def test_expressions_of_any_length(count):
    text = "SPDX-License-Identifier: " + " OR ".join(f"LicenseRef{k:060d}" for k in range(count)) + " OR MIT"
    assert L.scan(text.encode())[5] == "mit"


def test_no_match_is_longer_than_a_window():
    from re import _parser as parser

    def spaces(items):
        total = 0
        for op, value in items:
            kind = str(op)
            if kind == "LITERAL":
                total += value == 32
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                inner = spaces(value[2])
                total += inner * int(value[1]) if inner else 0
            elif kind == "SUBPATTERN":
                total += spaces(value[3])
            elif kind == "BRANCH":
                total += max(spaces(branch) for branch in value[1])
            elif kind in ("ASSERT", "ASSERT_NOT"):
                total += spaces(value[1])
        return total

    longest = max(spaces(parser.parse(rule.regex.pattern.decode())) for rule in L.rules() if not rule.expression)
    assert longest < L.WORDS


def test_texts_full_of_statements_take_linear_time():
    import time

    times = []
    for count in (8_000, 32_000):
        text = ("gpl license apache license mit license " * (count // 3)).encode()
        started = time.process_time()
        assert L.scan(text)[5] == "apache,gpl,mit"
        times.append(time.process_time() - started)
    assert times[1] < 8 * times[0] + 0.5
    chained = ("SPDX-License-Identifier: MIT OR Apache-2.0 AND " * 5_000).encode()
    started = time.process_time()
    assert "mit" in L.scan(chained)[5]
    assert time.process_time() - started < 30


def test_edge_cases(spark, odd_docs):
    rows = L.find(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.labels == "" and r.score == 0 and r.first_word is None for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert L.find(odd_docs.limit(0)).count() == 0
