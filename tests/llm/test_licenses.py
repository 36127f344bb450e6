import random
import re
from itertools import islice, product
from re import _constants as sre, _parser

import pytest

from fleetmatch.llm import licenses
from tests.llm.helpers import by_id, documents, no_documents, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text):
    """All detections by trying each rule at each word, then each against each other."""
    listed = words(text)
    found = []
    for number, rule in enumerate(licenses.RULES):
        line, at = "".join(" " + w for w in listed), 0
        for match in re.finditer(f" (?:{rule.pattern})(?= |$)", line):
            start = line[:match.start()].count(" ")
            found.append((start, start + match.group().count(" "), rule.rank, number, rule.label))
    stays = []
    for a in found:
        beaten = any(b is not a and b[0] <= a[0] and b[1] >= a[1] and b[2] <= a[2]
                     and ((b[0], -b[1], b[2], b[3]) < (a[0], -a[1], a[2], a[3])) for b in found)
        if a[3] < len(licenses.BASE_PHRASES) or not beaten:
            stays.append(a)
    base = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(listed))
            if listed[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in base]
    score = max((licenses.CONFIDENCE[d[2]] for d in stays), default=0.0)
    return (len(listed), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted({d[4] for d in stays})), score)


def test_rules_are_many_and_well_formed():
    assert len(licenses.RULES) > 200 and len({(r.label, r.pattern) for r in licenses.RULES}) > 200
    for rule in licenses.RULES:
        assert not re.compile(rule.pattern).fullmatch("") and rule.keyword == rule.keyword.lower()


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "All rights reserved. ALL RIGHTS RESERVED", "GNU General Public License, version 3.",
    "This work is licensed under the GNU General Public License, version 3", "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: GPL-2.0-or-later",
    "general public\n\nlicense general public license", "cc  by, cc-by; acc by", "cc bya", "xall rights reserved",
    "the software is copyright (c) 2020 2021 by me, all rights reserved", "nothing here", "éall rights reserved é",
    "licensed under a creative commons attribution non-commercial 4.0 license", "mit der Zeit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\")", "All " * 500 + "rights reserved " * 3,
]


def test_digest_is_that_of_a_plain_search(spark):
    rng = random.Random(1)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "gnu", "mit", "apache", "2", "0",
             "version", "the", "under", "licensed", "nc", "copyright", "spdx", "identifier", "gpl", "é", "x"]
    texts = TEXTS + [rng.choice([" ", "-"]).join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(300)]
    texts += ["all rights reserved. " * 2000]
    rows = by_id(licenses.license_digest(documents(spark, list(enumerate(texts)))))
    for i, text in enumerate(texts):
        assert rows[i] == [brute(text)], text[:200]


def test_containment_and_priority(spark):
    rows = by_id(licenses.license_digest(documents(spark, [(1, TEXTS[3]), (2, TEXTS[5]), (3, TEXTS[0])])))
    assert rows[1][0][4:6] == ("gpl", "gpl,gpl-3.0,other")
    assert rows[2][0][4:6] == ("", "apache-2.0") and rows[2][0][6] == 1.0
    assert rows[3][0][4] == "cc-by" and "cc-by-nc-4.0" in rows[3][0][5].split(",")


def test_odd_rows(spark):
    rows = by_id(licenses.license_digest(odd_documents(spark)))
    assert len(rows[1]) == 2 and rows[1][0] == (3, 0, None, None, "", "", 0.0)
    assert rows[2] == rows[3] == rows[5] == rows[6] == [(0, 0, None, None, "", "", 0.0)]
    assert rows[4][0][0] == 60000 and rows[7][0][0] == 5
    assert licenses.license_digest(no_documents(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.license_digest(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def samples(pattern):
    """Texts that a rule's pattern matches: each alternative, with and without what is optional."""
    def of(parts):
        return ("".join(found) for found in product(*[list(one(*part)) for part in parts]))

    def one(kind, value):
        if kind is sre.LITERAL:
            return [chr(value)]
        if kind is sre.IN:
            return [c for part in value for c in (["x"] if part[0] is sre.CATEGORY and part[1] is not sre.CATEGORY_DIGIT
                                                  else one(*part))]
        if kind is sre.CATEGORY:
            return ["1"]
        if kind is sre.SUBPATTERN:
            return of(value[3])
        if kind is sre.BRANCH:
            return [text for branch in value[1] for text in of(branch)]
        assert kind is sre.MAX_REPEAT, kind
        least, most, inner = value
        return [text * n for text in of(inner) for n in dict.fromkeys((least, min(most, least + 1)))]

    return dict.fromkeys(islice(of(_parser.parse(pattern)), 64))


def test_samples_match_their_rules():
    for rule in licenses.RULES:
        assert all(re.fullmatch(rule.pattern, text) for text in samples(rule.pattern))


def test_every_sample_has_the_keyword_of_its_rule():
    for rule in licenses.RULES:
        assert all(f" {rule.keyword}" in f" {text}" for text in samples(rule.pattern)), rule


def test_the_gate_opens_for_every_rule(spark):
    texts = sorted({next(iter(samples(rule.pattern))) for rule in licenses.RULES})
    texts += ["libfoo: LGPL-2.1", "AGPLv3", "implied warranties of merchantability"]
    docs = documents(spark, list(enumerate(texts)))
    # The same texts where a word that no rule knows opens the gate.
    opened = [*licenses.RULES, licenses.Rule(licenses.HINT, "none", "", "(?!)")]
    gated, ungated = (by_id(licenses.scan_licenses(docs, rules=rules)) for rules in (licenses.RULES, opened))
    assert gated == ungated and all(gated[i][0][1] for i in range(len(texts) - 3, len(texts)))
