"""License statements found by ordered signature rules.

A rule is a regular expression over the text's words (lower-cased, joined by single spaces), with a
label, a weight, a priority and keywords. One automaton finds all keywords in one pass over the text; a rule
runs only where one of its keywords stands, on all whole words that a match around it could take (`WORDS`, which
no rule exceeds). SPDX expressions may go on over any number of alternatives; the rules for these run over
whole expressions. Detections are taken by priority, then length, then position; one that lies within an
interval already taken is suppressed, so that "cc by nc" does not also report "cc by": of the taken
intervals those within no other are kept in order, so that one look-up decides. The base phrases come first of all
and are counted wherever they stand, overlaps included. The score is 1 - product(1 - weight) over the
labels, each with its best detection.

The rules come from the families below and the statement forms: every name and version with every form.
Identifiers and short names ("MIT", "PHP-3.01") have forms of their own, in which a license word stands beside them;
names that mean other things as well ("Apache", "EPL") need a license word where they stand alone.

Defined results: a null or empty text has no words, no labels and score 0; equal rows get equal rows;
an empty table gives no rows. Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlake.llm import common

# Phrases and the labels they give.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# label prefix, name as a regular expression over words, versions (words to label suffix), keyword
FAMILIES = [
    ("apache", r"apache(?: software)?(?: license)?", {"2(?: 0)?": "-2", "1 1": "-1.1", "1 0": "-1.0"}, "apache"),
    ("agpl", r"(?:gnu )?(?:affero general public license|agpl)", {"3(?: 0)?": "-3", "1(?: 0)?": "-1"}, "affero|agpl"),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", {"3(?: 0)?": "-3", "2 1": "-2.1", "2(?: 0)?": "-2"}, "lesser general|library general|lgpl"),
    ("gpl", r"(?:gnu )?(?:general public license|gpl)", {"3(?: 0)?": "-3", "2(?: 0)?": "-2", "1(?: 0)?": "-1"}, "general public|gpl"),
    ("gfdl", r"(?:gnu )?(?:free documentation license|gfdl|fdl)", {"1 3": "-1.3", "1 2": "-1.2", "1 1": "-1.1"}, "free documentation|fdl"),
    ("mpl", r"(?:mozilla public license|mpl)", {"2(?: 0)?": "-2", "1 1": "-1.1", "1 0": "-1.0"}, "mozilla|mpl"),
    ("epl", r"(?:eclipse public license|epl)", {"2(?: 0)?": "-2", "1(?: 0)?": "-1"}, "eclipse|epl"),
    ("cddl", r"(?:common development and distribution license|cddl)", {"1 1": "-1.1", "1(?: 0)?": "-1"}, "common development|cddl"),
    ("cpl", r"common public license", {"1(?: 0)?": "-1"}, "common public"),
    ("eupl", r"(?:european union public licen[cs]e|eupl)", {"1 2": "-1.2", "1 1": "-1.1"}, "european union|eupl"),
    ("artistic", r"artistic license", {"2(?: 0)?": "-2", "1(?: 0)?": "-1"}, "artistic"),
    ("boost", r"(?:boost software license|bsl)", {"1(?: 0)?": "-1"}, "boost software|bsl"),
    ("ofl", r"(?:sil )?(?:open font license|ofl)", {"1 1": "-1.1", "1 0": "-1.0"}, "open font|ofl"),
    ("osl", r"(?:open software license|osl)", {"3(?: 0)?": "-3", "2 1": "-2.1"}, "open software|osl"),
    ("afl", r"(?:academic free license|afl)", {"3(?: 0)?": "-3", "2 1": "-2.1"}, "academic free|afl"),
    ("cecill", r"cecill", {"2 1": "-2.1", "2(?: 0)?": "-2"}, "cecill"),
    ("zpl", r"zope public license", {"2 1": "-2.1", "2(?: 0)?": "-2"}, "zope"),
    ("php", r"php license", {"3 01": "-3.01", "3(?: 0)?": "-3"}, "php"),
    ("python", r"(?:python software foundation license|psf license)", {"2(?: 0)?": "-2"}, "python software|psf license"),
    ("odbl", r"(?:open database license|odbl)", {"1(?: 0)?": "-1"}, "open database|odbl"),
    ("cdla", r"community data license agreement(?: permissive| sharing)?", {"2(?: 0)?": "-2", "1(?: 0)?": "-1"}, "community data"),
    ("mit", r"(?:mit|expat)(?: x11)? license", {}, "mit license|x11 license|expat"),
    ("mit-0", r"(?:mit 0|mit no attribution(?: license)?)", {}, "mit 0|mit no attribution"),
    ("isc", r"isc license", {}, "isc license"),
    ("zlib", r"zlib(?: libpng)?(?: license)", {}, "zlib"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?", {}, "bsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd)(?: license)?", {}, "bsd"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|(?:simplified|freebsd) bsd)(?: license)?", {}, "bsd"),
    ("0bsd", r"(?:0bsd|zero clause bsd)(?: license)?", {}, "bsd"),
    ("bsd", r"bsd license", {}, "bsd"),
    ("unlicense", r"(?:the )?unlicense", {}, "unlicense"),
    ("wtfpl", r"wtfpl", {}, "wtfpl"),
    ("ms-pl", r"microsoft public license", {}, "microsoft public"),
    ("ms-rl", r"microsoft reciprocal license", {}, "microsoft reciprocal"),
    ("postgresql", r"postgresql license", {}, "postgresql"),
    ("openssl", r"openssl license", {}, "openssl"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? license", {}, "ncsa"),
    ("x11", r"x11 license", {}, "x11 license"),
    ("pddl", r"public domain dedication and license", {}, "public domain"),
    ("odc-by", r"open data commons attribution license", {}, "open data"),
]
# Identifiers and short names that stand for a license only in a form that says so. Those of SOFTWARE are
# also names of programs and need "licensed" or "released" before "under".
SHORT = {
    "cpl": ("cpl",), "artistic": ("artistic",), "boost": ("bsl", "boost 1"), "zpl": ("zpl",), "php": ("php 3",),
    "python": ("psf", "python 2"), "cdla": ("cdla",), "mit": ("mit", "expat"), "isc": ("isc",), "zlib": ("zlib",), "bsd": ("bsd",),
    "ms-pl": ("ms pl",), "ms-rl": ("ms rl",), "postgresql": ("postgresql",), "openssl": ("openssl",), "ncsa": ("ncsa",),
    "x11": ("x11",), "pddl": ("pddl",), "odc-by": ("odc by",),
}
RARE = frozenset(("cpl", "zpl", "cdla", "ms-pl", "ms-rl", "ncsa", "pddl", "odc-by"))  # keywords by themselves
SOFTWARE = frozenset(("php", "python", "zlib", "postgresql", "openssl", "x11", "boost"))
# Families with a short name that means other things as well: standing alone, the name needs a license word.
AMBIGUOUS = {
    "apache": r"apache(?: software)? licen[sc]e", "gfdl": r"(?:gnu )?(?:free documentation license|gfdl)", "mpl": r"mozilla public license",
    "epl": r"eclipse public license", "boost": r"boost software license", "ofl": r"(?:sil )?open font license",
    "osl": r"open software license", "afl": r"academic free license",
}
# Parts of Creative Commons names, and their versions.
CC_PARTS = {
    "by nc sa": r"(?:by nc sa|attribution non ?commercial share ?alike)",
    "by nc nd": r"(?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)",
    "by nc": r"(?:by nc|attribution non ?commercial)",
    "by sa": r"(?:by sa|attribution share ?alike)",
    "by nd": r"(?:by nd|attribution no ?deriv(?:ative)?s?)",
    "by": r"(?:by|attribution)",
}
CC_VERSIONS = ("4 0", "3 0", "2 5", "2 0", "1 0")
# Forms a statement takes: prefix, suffix, weight and priority.
FORMS = [
    (r"spdx license identifier ", r"", 1.0, 1),
    (r"(?:licen[sc]ed|released|distributed|available|published|provided|redistribute[d]?|made available)(?: to you)? under (?:the )?(?:terms of )?(?:the )?", r"", 0.95, 2),
    (r"(?:subject to|governed by|terms of|conditions of|pursuant to) (?:the )?", r"", 0.9, 3),
    (r"", r"(?: license)?(?: text| file| header| notice)", 0.7, 4),
    (r"", r"", 0.5, 5),
]
UNDER = r" under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
# Forms of short names, and of ambiguous ones: prefix, suffix, weight and priority.
SHORT_FORMS = [
    (r"spdx license identifier ", r"", 1.0, 1),
    (rf"(?:licen[sc]ed|released)(?: to you)?{UNDER}", r"", 0.95, 2),
    (r"licen[sc]es? (?:is |are )?(?:the )?", r"", 0.9, 3),
    (r"", r" licen[sc]e[ds]?", 0.7, 5),
]
LOOSE = (rf"(?:distributed|available|published|provided|redistributed?){UNDER}", r"", 0.95, 2)
# Further names of an expression; the span is the name's alone.
PART = r"(?:(?!(?:or|and|with|spdx) )[^ ]+ ){1,12}+(?:or|and|with) "  # of an SPDX expression, up to its operator
FURTHER = [
    (rf"spdx license identifier (?:{PART})+?(?P<at>", r")", 1.0, 1),
    (rf"(?:licen[sc]ed|released|distributed|available|published|provided)(?: to you)?{UNDER}(?:[^ ]+ ){{1,6}}?(?:or |and )(?:the )?(?P<at>", r")", 0.9, 3),
    (r"licen[sc]es? (?:[^ ]+ ){1,6}?(?:or |and )(?:the )?(?P<at>", r")", 0.7, 4),
]
# A full version with a license word at most six words away.
NEAR = [(r"licen[sc][^ ]* (?:[^ ]+ ){0,6}?(?P<at>", r")", 0.5, 5), (r"(?P<at>", r")(?= (?:[^ ]+ ){0,6}?licen[sc])", 0.5, 5)]
# The last words of the forms' prefixes; with a short name they are its keywords.
ENDINGS = ("identifier", "under", "the", "of", "license", "licence", "licenses", "licences", "is", "are", "or", "and")
# Statements without a license's name.
PLAIN = [
    ("cc0", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", 0.9, 2, "cc0|creative commons zero"),
    ("public-domain", r"(?:released into|dedicated to|placed in|in) the public domain", 0.8, 3, "public domain"),
    ("proprietary", r"(?:proprietary and confidential|may not be (?:copied|reproduced|distributed) without)", 0.6, 6, "proprietary and|may not be"),
    ("all-rights-reserved", r"all rights reserved", 0.4, 7, "all rights reserved"),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", 0.3, 8, "copyright"),
    ("permissive-text", r"permission is hereby granted free of charge to any person obtaining a copy", 0.9, 2, "hereby granted"),
    ("bsd-text", r"redistribution and use in source and binary forms", 0.9, 2, "redistribution and use"),
]
WORDS = 48  # words of the longest match of a rule, SPDX expressions aside; a test derives it from the rules
_EXPRESSION = re.compile(rf"(?<![^ ])spdx license identifier (?:{PART})+".encode())

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class Rule:
    def __init__(self, label: str, pattern: str, weight: float, priority: int, keyword: str):
        self.label, self.weight, self.priority = label, weight, priority
        self.keywords = tuple(keyword.encode().split(b"|"))
        self.regex = re.compile(rf"(?<![^ ]){pattern}(?![^ ])".encode())
        self.part = self.regex.groupindex.get("at", 0)
        self.expression = PART in pattern


def _named(label: str, name: str, versions: dict[str, str], keyword: str, prefix: str, suffix: str, weight: float, priority: int) -> list[Rule]:
    """One family in one form: its versions, then the bare name."""
    made = []
    for version, ending in versions.items():
        # A first number alone is no version where another one follows: "2.4" is not 2.
        version = version.replace("(?: 0)?", "(?: 0|(?! [0-9]{1,2}(?![^ ])))")
        made.append(Rule(label + ending, rf"{prefix}{name}(?: licen[sc]e)?(?: (?:version|v))? v?{version}{suffix}", weight, priority, keyword))
    return [*made, Rule(label, rf"{prefix}{name}{suffix}", weight * 0.9, priority, keyword)]


@cache
def rules() -> list[Rule]:
    """All rules in the order of their priority, versions before bare names."""
    made = []
    for prefix, suffix, weight, priority in FORMS:
        for part, name in CC_PARTS.items():
            label = "cc-" + part.replace(" ", "-")
            for version in CC_VERSIONS:
                made.append(Rule(f"{label}-{version.replace(' ', '.')}",
                                 rf"{prefix}(?:cc|creative commons) {name}(?: international| unported)? {version}{suffix}", weight, priority, "cc by|creative commons"))
            made.append(Rule(label, rf"{prefix}(?:cc|creative commons) {name}{suffix}", weight, priority, "cc by|creative commons"))
        for label, name, versions, keyword in FAMILIES:
            if label in AMBIGUOUS and not prefix:
                name = AMBIGUOUS[label]
            made += _named(label, name, versions, keyword, prefix, suffix, weight, priority)
    for label, name, versions, keyword in FAMILIES:
        short = SHORT.get(label, ())
        if short:
            # A name with a version in it stands before that version only.
            name = "(?:" + "|".join(re.sub("^([a-z]+) ([0-9])$", r"\1(?= \2)", word) for word in short) + ")"
            name += {"cdla": "(?: permissive| sharing)?", "pddl": "(?: 1 0)?", "odc-by": "(?: 1 0)?"}.get(label, "")
            afters = ["licen", *dict.fromkeys(version[0] for version in versions)]
            keyword = "|".join(short if label in RARE else [
                *(f"{ending} {word}" for word in short for ending in ENDINGS), *(f"{word} {after}" for word in short for after in afters), *(word for word in short if word[-1].isdigit())])
        for form in [*SHORT_FORMS, *FURTHER] + ([] if label in SOFTWARE else [LOOSE]):
            made += _named(label, name, versions, keyword, *form)
        if label in AMBIGUOUS:
            for form in NEAR:
                made += _named(label, name, {v.replace("(?: 0)?", " 0"): ending for v, ending in versions.items()}, keyword, *form)[:-1]
    made += [Rule(label, pattern, weight, priority, keyword) for label, pattern, weight, priority, keyword in PLAIN]
    return sorted(made, key=lambda rule: rule.priority)


@cache
def groups() -> list[list[Rule]]:
    """The rules by what calls them: keywords, and whether they run over expressions."""
    found: dict[tuple, list[Rule]] = {}
    for rule in rules():
        found.setdefault((rule.keywords, rule.expression), []).append(rule)
    return list(found.values())


@cache
def automaton() -> ahocorasick.Automaton:
    """Finds every keyword, with the numbers of the groups it calls. Bytes are read as Latin-1 characters."""
    called: dict[str, list[int]] = {}
    for number, group in enumerate(groups()):
        for keyword in group[0].keywords:
            called.setdefault(keyword.decode("latin-1"), []).append(number)
    made = ahocorasick.Automaton()
    for keyword, numbers in called.items():
        made.add_word(keyword, (len(keyword), numbers))
    made.make_automaton()
    return made


def _windows(places: list[int], starts: list[int], size: int) -> Iterator[tuple[int, int]]:
    """Stretches of whole words, WORDS to each side of the words at the places, merged where they meet."""
    first = last = -1  # words
    for at in places:
        word = bisect_right(starts, at) - 1
        if last < 0 or word - WORDS > last:
            if last >= 0:
                yield starts[first], starts[last + 1] - 1
            first = max(0, word - WORDS)
        last = min(word + WORDS, size - 1)
    yield starts[first], starts[last + 1] - 1


class Taken:
    """Intervals of which none lies within another, in order: starts and ends both rise."""

    def __init__(self) -> None:
        self.low: list[int] = []
        self.high: list[int] = []

    def add(self, low: int, high: int) -> bool:
        """Takes an interval unless it lies within one that is there."""
        at = bisect_right(self.low, low)
        if at and self.high[at - 1] >= high:
            return False
        first = bisect_left(self.low, low)
        last = max(first, bisect_right(self.high, high))
        self.low[first:last], self.high[first:last] = [low], [high]
        return True


def detections(body: bytes, starts: list[int], size: int) -> dict[tuple[int, int, int, str], tuple[int, int, Rule]]:
    """All matches of all rules, by the order in which they are taken."""
    called: dict[int, list[int]] = {}
    for end, (length, numbers) in automaton().iter(body.decode("latin-1")):
        for number in numbers:
            called.setdefault(number, []).append(end + 1 - length)
    found: dict[tuple[int, int, int, str], tuple[int, int, Rule]] = {}
    if not called:
        return found
    expressions: list[tuple[int, int]] | None = None
    for number, places in called.items():
        group = groups()[number]
        if group[0].expression:
            if expressions is None:
                expressions = []
                for m in _EXPRESSION.finditer(body):
                    word = bisect_left(starts, m.end())
                    expressions.append((m.start(), starts[min(word + WORDS, size)] - 1))
            windows = expressions
        else:
            # Of several keywords the shorter may end first and begin later.
            windows = list(_windows(sorted(places), starts, size))
        for low, high in windows:
            part = body[low:high]
            for rule in group:
                for m in rule.regex.finditer(part):
                    start, end = (low + at for at in m.span(rule.part))
                    found[rule.priority, start - end, start, rule.label] = (start, end, rule)
    return found


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float, str]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label:first:end words)."""
    words = text.translate(_LETTERS).split()
    body = b" ".join(words)
    starts = list(accumulate((len(word) + 1 for word in words), initial=0))  # of words, and behind the last
    padded = b" " + body + b" "
    places, base = [], set()
    for phrase, label in BASE.items():
        needle = b" " + phrase.encode() + b" "
        at = padded.find(needle)
        while at >= 0:
            places.append(bisect_left(starts, at))
            base.add(label)
            at = padded.find(needle, at + 1)
    found = detections(body, starts, len(words))
    if not found and not places:
        return len(words), 0, None, None, "", "", 0.0, ""
    taken = Taken()
    best: dict[str, float] = dict.fromkeys(base, 0.95)
    spans = []
    for _, (start, end, rule) in sorted(found.items()):
        if taken.add(start, end):
            best[rule.label] = max(best.get(rule.label, 0.0), rule.weight)
            spans.append((bisect_left(starts, start), bisect_left(starts, end), rule.label))
    miss = 1.0
    for label in sorted(best):
        miss *= 1.0 - best[label]
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(best)), round(1.0 - miss, 6),
        ",".join(f"{label}:{a}:{b}" for a, b, label in sorted(spans)),
    )


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans string"
)


def find(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, labels, score and spans of scan()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scan(text.as_py()) for text in batch.column("body").cast(pa.binary())]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), common.whole().alias("body")).mapInArrow(run, SCHEMA)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return find(common.table(spark, folder, "documents"))
