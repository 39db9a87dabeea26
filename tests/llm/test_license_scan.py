import re
from re import _constants as op
from re import _parser

import pytest

from patronage.llm import license_rules, license_scan

PHRASES = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def base(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    places = [(k, label) for k in range(len(words)) for phrase, label in PHRASES.items() if tuple(w.decode("utf-8", "replace") for w in words[k : k + len(phrase)]) == phrase]
    return len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", " ", "MIT License", "mit-license mit license MIT LICENSE", "a b cc by cc by-sa", "the Apache\nLicense, Version 2.0.", "GNU General Public License general",
    "gnu lesser general public license", "émit license", "mit licensé", "1mit license 2", "MIT_LICENSE", "x" * 10000 + " cc by " + "y " * 5000, "ÀPACHE license apache license",
]


def test_base_columns(spark):
    rows = list(enumerate(TEXTS)) + [(3, "MIT License"), (None, "cc by")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS labels")
    found = license_scan.scan(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "cc by" if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan.scan(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def scanner():
    return license_scan.Scanner(license_rules.rules())


def test_there_are_hundreds_of_rules_and_each_keyword_is_needed(scanner):
    assert len(scanner.ordered) > 300
    for rule in scanner.ordered:
        assert rule.keyword and rule.keyword == rule.keyword.lower()


@pytest.mark.parametrize(
    "text, labels",
    [
        ("under the GNU Affero General Public License, version 3", ["agpl"]),
        ("GNU Lesser General Public License v2.1", ["lgpl"]),
        ("# SPDX-License-Identifier: BSD-3-Clause", ["bsd"]),
        ("Licensed under the Apache License, Version 2.0 (the License)", ["apache"]),
        ("see https://creativecommons.org/licenses/by-nc-sa/4.0/", ["cc-by-nc-sa"]),
        ("Permission is hereby granted, free of charge, to any person\n * obtaining a copy", ["mit"]),
        ("Creative Commons Attribution-ShareAlike 4.0", ["cc-by-sa"]),
        ("All rights reserved.", ["proprietary"]),
        ("a permit licensee of the committee", []),
    ],
)
def test_overlapping_detections(scanner, text, labels):
    assert sorted({rule.label for _, _, rule in scanner.detect(text)}) == labels


def test_containment_is_that_of_all_pairs(scanner):
    import random

    source = random.Random(3)
    for _ in range(200):
        reach, seen = [], []
        for _ in range(30):
            start = source.randrange(40)
            end = start + 1 + source.randrange(15)
            inside = any(a <= start and end <= b for a, b in seen)
            assert license_scan._contained(reach, start, end) == inside
            if not inside:
                seen.append((start, end))
                license_scan._add(reach, start, end)


def test_a_rule_fits_only_texts_with_its_keyword(scanner):
    words = ["mit license", "apache license, version 2.0", "cc0 1.0", "spdx-license-identifier: mit", "mozilla public license 2.0", "www.gnu.org/licenses/gpl", "zlib license", "license: isc"]
    for text in words:
        for rule in scanner.ordered:
            if rule.pattern.search(text):
                assert rule.keyword in text, (rule, text)


def examples(items):
    """Texts that a parsed pattern fits: each alternative, and each optional part once there and once not."""
    out = [""]
    for kind, value in items:
        if kind is op.LITERAL:
            found = [chr(value)]
        elif kind is op.SUBPATTERN:
            found = examples(value[3])
        elif kind is op.BRANCH:
            found = [text for branch in value[1] for text in examples(branch)]
        elif kind is op.MAX_REPEAT:
            found = [text * times for times in {value[0], min(value[1], value[0] + 1)} for text in examples(value[2])]
        elif kind is op.IN:
            found = [chr(v) if k is op.LITERAL else chr(v[0]) if k is op.RANGE else "x" if "NOT_SPACE" in str(v) else " " for k, v in value]
        elif kind is op.ANY:
            found = ["x"]
        else:
            found = [""]
        # not each with each: one part differs from its first text at a time
        out = [out[0] + text for text in found] + [text + found[0] for text in out[1:]]
    return list(dict.fromkeys(out))


def test_no_rule_misses_an_alternative_for_its_keyword(scanner):
    tried = 0
    for rule in scanner.ordered:
        texts = [text for text in examples(_parser.parse(rule.pattern.pattern)) if rule.pattern.search(text)]
        assert texts, rule
        tried += len(texts)
        for text in texts:
            assert rule.keyword in text, (rule, text)
    assert tried > 2000


def test_detections_are_those_without_keywords(scanner):
    free = license_scan.Scanner([rule._replace(keyword="") for rule in scanner.ordered])
    for rule in scanner.ordered:
        for text in examples(_parser.parse(rule.pattern.pattern))[:4]:
            gated, ungated = ([(a, b, r.label) for a, b, r in one.detect(f"see {text}.")] for one in (scanner, free))
            assert gated == ungated, text


@pytest.mark.parametrize(
    "text, label",
    [
        ("licensed under the WTFPL", "wtfpl"), ("GNU AGPL v3", "agpl"), ("Lesser GPL", "lgpl"), ("under the terms of the GPL v3", "gpl"), ("PSF license", "psf"),
        ("X Consortium license", "x11"), ("Internet Systems Consortium license", "isc"), ("Open Data Commons Database License", "odbl"), ("the Expat license", "mit"),
        ("see unicode.org/copyright", "unicode"), ("see unicode.org/license", "unicode"), ("it is free software: you can redistribute it and/or modify it", "gpl"),
        ("University of Illinois Open Source License", "ncsa"),
    ],
)
def test_names_without_the_keyword_of_their_licence(scanner, text, label):
    assert label in {rule.label for _, _, rule in scanner.detect(text)}
