"""License scans (operator 3): ordered signature rules.

A text is lower-cased (A-Z) and reduced to its words, joined by single blanks.
``RULES`` are regular expressions over that line, written by family, version
and wording, each with a label, a priority and the keyword that a text must
have as a word before the expression is tried at all. Detections are resolved
from high priority to low and from long to short: one whose span lies inside
that of an earlier one is suppressed (the "general public license" inside
"gnu lesser general public license" is no detection of its own).

Three base phrases are found by their words' places, apart from the rules.
Everything is local to a document: a Pandas UDF over whole texts, no shuffle.

Defined cases: null text is empty: no words, no labels, score 0; repeated rows
and null ids are scanned like any other; ties between detections go to the
rule that comes first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from . import common, notices

_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))

# Base phrases: words and label.
PHRASES = ((b"mit", b"license"), "mit"), ((b"apache", b"license"), "apache"), \
    ((b"general", b"public", b"license"), "gpl")


class Rule(NamedTuple):
    label: str
    keyword: bytes          # a word that the text must have
    pattern: re.Pattern
    priority: int           # higher first
    score: float


def _rule(label: str, keyword: str, pattern: str, priority: int) -> Rule:
    return Rule(label, keyword.encode(), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode()), priority,
                {4: 1.0, 3: 0.9, 2: 0.75, 1: 0.5}[priority])


def longest_word(pattern: str) -> str:
    """The longest word that any match has: not one of a group, of which a match
    may have another, and not half of one that may be written as two."""
    plain = re.sub(r"[a-z]+ \?[a-z]+", "?", re.sub(r"\([^()]*\)\??", "", pattern))
    return max((w for w in plain.split(" ") if re.fullmatch("[a-z0-9]+", w)), key=len)


def build_rules() -> list[Rule]:
    """All rules, from the most to the least specific of each family.
    Priorities: 4 identifiers and whole sentences, 3 names with a version,
    2 names, 1 hints."""
    rules: list[Rule] = []
    lic = "licen[cs]e"

    def add(label, keyword, pattern, priority):
        rules.append(_rule(label, keyword, pattern, priority))

    # GNU family: name, abbreviation, words between "gnu" and "general public"
    for short, middle in (("agpl", "affero "), ("lgpl", "(?:lesser|library) "), ("gpl", "")):
        for major, minor in ((1, 0), (2, 0), (2, 1), (3, 0)):
            v = f"{major}(?: {minor})?" if minor == 0 else f"{major} {minor}"
            label = f"{short}-{major}.{minor}"
            add(label, "spdx", rf"spdx {lic} identifier {short} {major} {minor}(?: only| or later)?", 4)
            add(label, "general", rf"(?:gnu )?{middle}general public {lic} (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?{v}(?: or (?:any )?later(?: version)?)?", 3)
            add(label, short, rf"(?:gnu )?{short} (?:v ?)?{v}(?: only| or later)?", 3)
            add(label, f"{short}{major}", rf"(?:gnu )?{short}{v}", 3)
            add(label, f"{short}v{major}", rf"(?:gnu )?{short}v{v}", 3)
            add(label, "gnu", rf"gnu {short} (?:{lic} )?version {v}", 3)
        add(short, "general", rf"(?:gnu )?{middle}general public {lic}", 2)
        add(short, short, rf"gnu {short}|{short} {lic}(?:d)?|(?:under|released under|licensed under) (?:the )?(?:gnu )?{short}", 2)
    add("gfdl", "documentation", rf"gnu free documentation {lic}(?: version \d(?: \d)?)?", 3)
    add("gpl", "gnu", r"licensed under (?:the )?gnu", 1)
    # Apache
    for v in ("2 0", "1 1", "1 0"):
        label = f"apache-{v.replace(' ', '.')}"
        add(label, "spdx", rf"spdx {lic} identifier apache {v}", 4)
        add(label, "apache", rf"licensed under the apache {lic} version {v}", 4)
        add(label, "apache", rf"apache (?:software )?(?:{lic} )?(?:version |v )?{v}(?: {lic})?", 3)
        add(label, "apache", rf"apache org licenses {lic} {v}", 3)
    add("apache-2.0", "apache", rf"apache (?:{lic} )?v?2", 2)
    add("apache", "apache", rf"apache (?:software )?{lic}", 2)
    add("apache", "asf", r"licensed to the apache software foundation asf", 3)
    # MIT and the like
    add("mit", "spdx", rf"spdx {lic} identifier mit(?: 0)?", 4)
    add("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 4)
    add("mit", "mit", rf"(?:the )?mit (?:expat )?{lic}", 2)
    add("mit", "mit", rf"(?:under|licensed under|released under) (?:the )?mit", 2)
    add("isc", "spdx", rf"spdx {lic} identifier isc", 4)
    add("isc", "purpose", r"permission to use copy modify and or distribute this software for any purpose", 4)
    add("isc", "isc", rf"isc {lic}", 2)
    add("x11", "x11", rf"x11 {lic}", 2)
    # BSD by number of clauses
    for n, word in ((0, "zero"), (1, "one"), (2, "two"), (3, "three"), (4, "four")):
        label = f"bsd-{n}-clause"
        add(label, "spdx", rf"spdx {lic} identifier bsd {n} clause", 4)
        add(label, "bsd", rf"bsd (?:{n}|{word}) clause(?: {lic})?", 3)
        add(label, "bsd", rf"(?:{n}|{word}) clause bsd(?: {lic})?", 3)
    for name, label in (("new", "bsd-3-clause"), ("modified", "bsd-3-clause"), ("revised", "bsd-3-clause"),
                        ("simplified", "bsd-2-clause"), ("freebsd", "bsd-2-clause"), ("original", "bsd-4-clause")):
        add(label, name if name == "freebsd" else "bsd", rf"{name} {lic}" if name == "freebsd" else rf"{name} bsd {lic}", 3)
    add("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 4)
    add("bsd", "bsd", rf"bsd(?: style)? {lic}", 2)
    # Creative Commons: terms by version, short and long
    long = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
    for terms in (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        words = " ".join(long[t] for t in terms)
        name = "cc-" + "-".join(terms)
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            label = f"{name}-{v.replace(' ', '.')}"
            add(label, "spdx", rf"spdx {lic} identifier cc {' '.join(terms)} {v}", 4)
            add(label, "cc", rf"(?:licensed under )?(?:a )?cc {' '.join(terms)}(?: {lic})? {v}", 3)
            add(label, "creative", rf"creative commons {words}(?: {v})(?: (?:international|unported|generic))?(?: {lic})?", 3)
            add(label, "creativecommons", rf"creativecommons org licenses {' '.join(terms)} {v}", 4)
        add(name, "cc", rf"cc {' '.join(terms)}", 2)
        add(name, "creative", rf"creative commons {words}(?: {lic})?", 2)
    add("cc0-1.0", "spdx", rf"spdx {lic} identifier cc0 1 0", 4)
    add("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 3)
    add("cc", "creative", rf"creative commons {lic}|licensed under creative commons", 1)
    # other licences by version
    for label, keyword, name, versions in (
            ("mpl", "mozilla", f"mozilla public {lic}", ("1 0", "1 1", "2 0")), ("mpl", "mpl", "mpl", ("1 0", "1 1", "2 0")),
            ("epl", "eclipse", f"eclipse public {lic}", ("1 0", "2 0")), ("epl", "epl", "epl", ("1 0", "2 0")),
            ("cddl", "cddl", "cddl", ("1 0", "1 1")),
            ("cddl", "distribution", f"common development and distribution {lic}", ("1 0", "1 1")),
            ("cpl", "common", f"common public {lic}", ("1 0",)), ("eupl", "eupl", "eupl", ("1 0", "1 1", "1 2")),
            ("eupl", "union", f"european union public {lic}", ("1 0", "1 1", "1 2")),
            ("osl", "open", f"open software {lic}", ("1 0", "1 1", "2 0", "2 1", "3 0")),
            ("afl", "academic", f"academic free {lic}", ("1 2", "2 0", "2 1", "3 0")),
            ("artistic", "artistic", f"artistic {lic}", ("1 0", "2 0")), ("bsl", "boost", f"boost software {lic}", ("1 0",)),
            ("php", "php", f"php {lic}", ("3 0", "3 01")), ("psf", "python", f"python software foundation {lic}", ("2", "2 0")),
            ("ofl", "open", f"open font {lic}", ("1 0", "1 1")), ("ms-pl", "microsoft", f"microsoft public {lic}", ("1 0",)),
            ("ms-rl", "microsoft", f"microsoft reciprocal {lic}", ("1 0",)), ("zpl", "zope", f"zope public {lic}", ("1 1", "2 0", "2 1")),
            ("odbl", "database", f"open database {lic}", ("1 0",)), ("busl", "business", f"business source {lic}", ("1 0", "1 1")),
            ("sspl", "sspl", "sspl", ("1 0",)), ("sspl", "server", f"server side public {lic}", ("1", "1 0")),
            ("elastic", "elastic", f"elastic {lic}", ("1 0", "2 0")), ("nposl", "profit", f"non profit open software {lic}", ("3 0",))):
        for v in versions:
            add(f"{label}-{v.replace(' ', '.')}", keyword, rf"{name} (?:version |v )?{v}", 3)
        add(label, keyword, rf"{name}" if " " in name else rf"{name} {lic}", 2)
    for label, keyword, pattern, priority in (
            ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 4),
            ("unlicense", "unlicense", "the unlicense", 2), ("wtfpl", "wtfpl", "wtfpl", 2),
            ("zlib", "zlib", f"zlib (?:libpng )?{lic}", 2), ("zlib", "warranty", "provided as is without any express or implied warranty", 3),
            ("public-domain", "domain", "(?:released into|in|dedicated to) the public domain", 2),
            ("proprietary", "rights", "all rights reserved", 1), ("proprietary", "confidential", "proprietary and confidential", 2),
            ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|use)(?: or distribution)?", 2),
            ("proprietary", "commercial", f"commercial {lic}(?: agreement)?", 2),
            ("copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)\d\d", 1),
            ("unknown-license", "licensed", r"licensed under(?: the)?", 1), ("unknown-license", "terms", f"(?:under|subject to) the terms of (?:the|this) {lic}", 1)):
        add(label, keyword, pattern, priority)
    # sentences of licences and notices, names without a version
    for label, lines in notices.SENTENCES.items():
        for sentence in lines.strip().split("\n"):
            add(label, longest_word(sentence), sentence, 4)
    for label, name in notices.NAMES.items():
        add(label, longest_word(name), f"{name} {lic}", 2)
    return rules


class Detection(NamedTuple):
    label: str
    start: int      # bytes in the joined words
    stop: int
    score: float


class Scanner:
    def __init__(self, rules: list[Rule] | None = None):
        by: dict[bytes, list[tuple[int, Rule]]] = {}
        for i, rule in enumerate(build_rules() if rules is None else rules):
            by.setdefault(rule.keyword, []).append((i, rule))
        self.by, self.keywords = by, frozenset(by)

    def detections(self, words: list[bytes]) -> list[Detection]:
        """What is left after suppression, in order of place."""
        gates = self.keywords.intersection(words)
        if not gates:
            return []
        line = b" ".join(words)
        found = [(-rule.priority, m.start() - m.end(), i, m.start(), m.end(), rule)
                 for g in gates for i, rule in self.by[g] for m in rule.pattern.finditer(line)]
        found.sort(key=lambda x: x[:4])
        kept: list[Detection] = []
        starts: list[int] = []      # spans that suppress, none inside another: starts and stops both rise
        stops: list[int] = []
        for _, _, _, a, b, rule in found:
            at = bisect_right(starts, a)
            if at and stops[at - 1] >= b:
                continue
            kept.append(Detection(rule.label, a, b, rule.score))
            end = at                # spans inside the new one suppress nothing that it does not
            begin = at - 1 if at and starts[at - 1] == a else at
            while end < len(stops) and stops[end] <= b:
                end += 1
            starts[begin:end], stops[begin:end] = [a], [b]
        return sorted(kept, key=lambda d: (d.start, d.stop, d.label))

    def scan(self, text: str | None) -> dict:
        words = common.word_bytes(text).translate(_LETTERS).split()
        places, base = [], set()
        if b"license" in words:
            for i, w in enumerate(words):
                if w == b"license":
                    for phrase, label in PHRASES:
                        if i + 1 >= len(phrase) and tuple(words[i + 1 - len(phrase):i + 1]) == phrase:
                            places.append(i + 1 - len(phrase))
                            base.add(label)
        found = self.detections(words)
        return {"n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
                "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
                "labels": ",".join(sorted(base | {d.label for d in found})),
                "score": max([d.score for d in found] + [0.6] * bool(places), default=0.0)}


FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, word count, base places and labels, all
    labels, score of the surest detection."""
    def make():
        import pandas as pd
        scanner = Scanner()

        def run(texts):
            rows = [scanner.scan(t) for t in texts]
            out = {f: [r[f] for r in rows] for f in FIELDS}
            return out | {f: pd.array(out[f], "Int64") for f in ("first_word", "last_word")}
        return run
    kinds = ["long"] * 4 + ["string"] * 2 + ["double"]
    schema = ", ".join(f"{f} {k}" for f, k in zip(FIELDS, kinds))
    return common.with_fields(docs, [id_col], text_col, common.per_text(schema, make), FIELDS)


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    common.prepare(spark)
    return scan(common.documents(spark, sf_dir))
