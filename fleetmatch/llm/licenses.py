"""License detection by ordered signature rules, in Spark's own expressions.

A text is lower-cased and reduced to its words, joined by single spaces. Each rule
is a regular expression over those words with a keyword; a rule runs only where
its keyword occurs, and a text without any keyword is done after the keyword test.
Detections are word intervals. One that lies inside an interval of a rule of the
same or a better rank is suppressed; of equal intervals the better rank stays,
then the earlier rule. The base phrases are always kept, also inside others.

``n_words`` counts the words of the whole text; ``n_base``, ``first_word`` and
``last_word`` are about the places of the base phrases. ``score`` is the largest
confidence among the detections that stay, 0 if there is none. A null text
counts as empty: no words, no labels (empty strings), null places. Rows are
independent: repeated rows and repeated or null ids give repeated results, an
empty table an empty result; other columns do not matter. Work in a row grows
with the text, and with the square of its detections only in copying places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import pick

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrase and label.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Rank and confidence: whole notices and identifiers, names with a version, names, hints.
NOTICE, VERSION, NAME, HINT = range(4)
CONFIDENCE = (1.0, 0.9, 0.8, 0.5)


@dataclass(frozen=True)
class Rule:
    rank: int
    label: str
    keyword: str  # occurs in all that the pattern matches; must occur in the words for the rule to run
    pattern: str  # over words with single spaces between them


# One rule a line: label | keyword | pattern. {v} stands for an optional "version" or "v" before a number.
_NOTICES = """
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software (?:\\w+ ){1,8}without restriction
isc | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee
hpnd | permission to use copy | permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | neither the name | neither the name(?:s)? of (?:\\S+ ){1,12}nor the names of (?:its|their|any) contributors may be used
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display
apache-2.0 | licensed under the apache | licensed under the apache license {v}2(?: 0)?
apache-2.0 | you may not use this file | you may not use this file except in compliance with the license
apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
gpl-2.0-or-later | either version 2 | gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0-or-later | either version 3 | gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl-2.1-or-later | either version 2 1 | gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
agpl-3.0-or-later | gnu affero | gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl | free software you can redistribute | this (?:program|library|file) is free software you can redistribute it and or modify it under the terms of
mpl-2.0 | mozilla public | this source code form is subject to the terms of the mozilla public license {v}2 0
mpl-1.1 | mozilla public | subject to the mozilla public license version 1 1
epl-2.0 | eclipse public | made available under the terms of the eclipse public license {v}2 0
epl-1.0 | eclipse public | made available under the terms of the eclipse public license {v}1 0
unlicense | released into the public domain | this is free and unencumbered software released into the public domain
cc0-1.0 | waived all copyright | has waived all copyright and related or neighboring rights
wtfpl | do what the fuck | do what the fuck you want to public license
zlib | provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable
boost-1.0 | boost software license | distributed under the boost software license {v}1 0
artistic-2.0 | artistic license | the artistic license 2 0
ofl-1.1 | open font license | this font software is licensed under the sil open font license {v}1 1
postgresql | without a written agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
python-2.0 | python software foundation | python software foundation license {v}2
openssl | openssl project | this product includes software developed by the openssl project
json | good not evil | the software shall be used for good not evil
proprietary | proprietary and confidential | (?:unauthorized copying of this file (?:\\w+ ){1,8})?proprietary and confidential
proprietary | may not be reproduced | may not be reproduced (?:\\w+ ){0,12}without (?:the )?(?:prior )?(?:express )?written permission
reserved | no part of this | no part of this (?:publication|book|document|work) may be reproduced
beerware | beer ware | the beer ware license
edl-1.0 | eclipse distribution | eclipse distribution license {v}1 0
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
ncsa | ncsa open source | university of illinois ncsa open source license
"""

_VERSIONS = """
gpl-1.0 | general public license | (?:gnu )?general public license {v}1(?: 0)?
gpl-2.0 | general public license | (?:gnu )?general public license {v}2(?: 0)?
gpl-3.0 | general public license | (?:gnu )?general public license {v}3(?: 0)?
lgpl-2.0 | general public license | (?:gnu )?(?:lesser|library) general public license {v}2 0
lgpl-2.1 | general public license | (?:gnu )?lesser general public license {v}2 1
lgpl-3.0 | general public license | (?:gnu )?lesser general public license {v}3(?: 0)?
agpl-3.0 | general public license | (?:gnu )?affero general public license {v}3(?: 0)?
gfdl-1.2 | free documentation license | (?:gnu )?free documentation license {v}1 2
gfdl-1.3 | free documentation license | (?:gnu )?free documentation license {v}1 3
gpl-2.0 | gpl | (?:gnu )?gpl ?{v}2(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl ?{v}3(?: 0)?
gpl-2.0 | gplv2 | gplv2(?: 0)?
gpl-3.0 | gplv3 | gplv3(?: 0)?
lgpl-2.1 | lgpl | lgpl ?{v}2 1
lgpl-3.0 | lgpl | lgpl ?{v}3(?: 0)?
lgpl-3.0 | lgplv3 | lgplv3(?: 0)?
agpl-3.0 | agpl | agpl ?{v}3(?: 0)?
agpl-3.0 | agplv3 | agplv3(?: 0)?
apache-1.0 | apache | apache(?: software)? license {v}1 0
apache-1.1 | apache | apache(?: software)? license {v}1 1
apache-2.0 | apache | apache(?: software)? license {v}2(?: 0)?
apache-2.0 | apache 2 | apache 2(?: 0)?(?: licensed| license)?
apache-2.0 | asl 2 0 | asl 2 0
mpl-1.0 | mozilla public license | mozilla public license {v}1 0
mpl-1.1 | mozilla public license | mozilla public license {v}1 1
mpl-2.0 | mozilla public license | mozilla public license {v}2(?: 0)?
mpl-2.0 | mpl | mpl ?{v}2 0
mpl-1.1 | mpl | mpl ?{v}1 1
epl-1.0 | eclipse public license | eclipse public license {v}1 0
epl-2.0 | eclipse public license | eclipse public license {v}2 0
epl-2.0 | epl | epl ?{v}2 0
cddl-1.0 | common development and distribution | common development and distribution license {v}1 0
cddl-1.1 | common development and distribution | common development and distribution license {v}1 1
cpl-1.0 | common public license | common public license {v}1 0
eupl-1.1 | european union public | european union public licen[cs]e {v}1 1
eupl-1.2 | european union public | european union public licen[cs]e {v}1 2
afl-3.0 | academic free license | academic free license {v}3 0
osl-3.0 | open software license | open software license {v}3 0
artistic-1.0 | artistic license | artistic license {v}1 0
artistic-2.0 | artistic license | artistic license {v}2 0
bsd-2-clause | bsd | (?:bsd )?(?:2|two) clause (?:simplified )?bsd(?: license)?
bsd-3-clause | bsd | (?:bsd )?(?:3|three) clause (?:new |revised |modified )?bsd(?: license)?
bsd-4-clause | bsd | (?:4|four) clause bsd(?: license)?
bsd-2-clause | bsd 2 clause | bsd 2 clause(?: license)?
bsd-3-clause | bsd 3 clause | bsd 3 clause(?: license)?
bsd-2-clause | simplified bsd | simplified bsd(?: license)?
bsd-3-clause | new bsd | new bsd license
cc-by-1.0 | cc by | cc by {v}1 0
cc-by-2.0 | cc by | cc by {v}2 0
cc-by-2.5 | cc by | cc by {v}2 5
cc-by-3.0 | cc by | cc by {v}3 0
cc-by-4.0 | cc by | cc by {v}4 0
cc-by-sa-3.0 | cc by sa | cc by sa {v}3 0
cc-by-sa-4.0 | cc by sa | cc by sa {v}4 0
cc-by-nc-2.0 | cc by nc | cc by nc {v}2 0
cc-by-nc-3.0 | cc by nc | cc by nc {v}3 0
cc-by-nc-4.0 | cc by nc | cc by nc {v}4 0
cc-by-nd-3.0 | cc by nd | cc by nd {v}3 0
cc-by-nd-4.0 | cc by nd | cc by nd {v}4 0
cc-by-nc-sa-3.0 | cc by nc sa | cc by nc sa {v}3 0
cc-by-nc-sa-4.0 | cc by nc sa | cc by nc sa {v}4 0
cc-by-nc-nd-3.0 | cc by nc nd | cc by nc nd {v}3 0
cc-by-nc-nd-4.0 | cc by nc nd | cc by nc nd {v}4 0
cc-by-3.0 | creative commons attribution | creative commons attribution {v}3 0(?: \\w+)? license
cc-by-4.0 | creative commons attribution | creative commons attribution {v}4 0 international(?: public)?(?: license)?
cc-by-sa-3.0 | creative commons attribution | creative commons attribution share ?alike {v}3 0
cc-by-sa-4.0 | creative commons attribution | creative commons attribution share ?alike {v}4 0
cc-by-nc-4.0 | creative commons attribution | creative commons attribution non ?commercial {v}4 0
cc-by-nd-4.0 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s {v}4 0
cc-by-nc-sa-4.0 | creative commons attribution | creative commons attribution non ?commercial share ?alike {v}4 0
cc-by-nc-nd-4.0 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s {v}4 0
cc0-1.0 | cc0 | cc0 {v}1 0(?: universal)?
odbl-1.0 | open database license | open (?:data commons )?open database license(?: {v}1 0)?
ogl-3.0 | open government | open government licen[cs]e {v}3 0
lppl-1.3c | project public license | latex project public license(?: {v}1 3c?)?
"""

_NAMES = """
mit | mit license | (?:the )?mit license
mit | mit licence | (?:the )?mit licence
mit | expat license | expat license
mit | licensed under mit | licensed under mit
isc | isc license | (?:the )?isc license
bsd | bsd | (?:the )?bsd(?: style)? license
apache | apache | (?:the )?apache(?: software)? license
gpl | gnu gpl | (?:the )?gnu gpl
lgpl | lesser general public | (?:gnu )?lesser general public license
lgpl | library general public | (?:gnu )?library general public license
lgpl | lgpl | (?:gnu )?lgpl
agpl | affero general public | (?:gnu )?affero general public license
agpl | agpl | (?:gnu )?agpl
gpl | gpl | gpl(?:ed)?(?: license)?
gfdl | free documentation license | (?:gnu )?free documentation license
mpl | mozilla public license | mozilla public license
epl | eclipse public license | eclipse public license
cddl | common development and distribution | common development and distribution license
eupl | european union public | european union public licen[cs]e
zlib | zlib | zlib(?: libpng)? license
boost-1.0 | boost software license | boost software license
artistic | artistic license | artistic license
unlicense | the unlicense | the unlicense
wtfpl | wtfpl | wtfpl
cc0 | cc0 | cc0
cc-by-sa | cc by sa | cc by sa
cc-by-nc | cc by nc | cc by nc
cc-by-nd | cc by nd | cc by nd
cc-by-nc-sa | cc by nc sa | cc by nc sa
cc-by-nc-nd | cc by nc nd | cc by nc nd
cc-by | creative commons attribution | creative commons attribution(?: license)?
cc-by-sa | creative commons attribution | creative commons attribution share ?alike
cc-by-nc | creative commons attribution | creative commons attribution non ?commercial
cc-by-nd | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s
cc-by-nc-sa | creative commons attribution | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s
creative-commons | creative commons | (?:under a )?creative commons(?: license)?
ofl | open font license | (?:sil )?open font license
odbl | odbl | odbl
odc-by | odc by | odc by
pddl | public domain dedication | public domain dedication(?: and license)?
vim | vim license | vim license
php | php license | php license
ruby | ruby license | ruby license
ruby | ruby s license | ruby s license
sleepycat | sleepycat | sleepycat license
upl-1.0 | universal permissive | universal permissive license
bsl-1.1 | business source | business source license
sspl-1.0 | server side public | server side public license
elastic-2.0 | elastic license | elastic license(?: 2 0)?
openrail | openrail | (?:creativeml )?openrail(?: m)?(?: license)?
openrail | open rail | (?:creativeml )?open rail(?: m)?(?: license)?
"""

_HINTS = """
public-domain | public domain | (?:in|into|to|is) the public domain
public-domain | dedicated to the public | dedicated to the public(?: domain)?
public-domain | copyright | no (?:known )?copyright
reserved | all right reserved | all right reserved
reserved | some rights reserved | some rights reserved
copyright | copyright c | copyright c (?:by )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)*
copyright | copyright | copyright (?:by )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)*
copyright | copyright | copyright holders?
copyright | copr | copr (?:19|20)\\d\\d
proprietary | proprietary | proprietary license
proprietary | license agreement | end user license agreement
proprietary | eula | eula
non-commercial | for non | for non ?commercial (?:use|purposes) only
non-commercial | personal use | for personal use only
non-commercial | for academic | for academic (?:use|purposes) only
non-commercial | for research | for research (?:use|purposes) only
no-derivatives | derivative works | no derivative works
share-alike | share alike | share alike
warranty-disclaimer | without warranty | without warranty of any kind
warranty-disclaimer | warranties or conditions | without warranties or conditions of any kind
warranty-disclaimer | implied warranties | implied warranties of merchantability
redistribution | redistribut | (?:may|can) be (?:freely )?redistributed
permission | with permission | (?:re)?(?:printed|used|published) with permission
permission | by permission | (?:re)?(?:printed|used|published) by permission
open-source | open source | open source (?:software )?licen[cs]e
free-software | free software | (?:is|as) free software
other | licensed under | (?:is )?licensed under (?:the )?(?:terms of )?(?:the )?
other | released under | released under (?:the )?(?:terms of )?(?:the )?
other | distributed under | distributed under (?:the )?(?:terms of )?(?:the )?
other | see the licen | see the licen[cs]e(?: file)?
"""


def _rules() -> list[Rule]:
    rules = [Rule(NOTICE, label, phrase, phrase) for phrase, label in BASE_PHRASES.items()]
    for rank, lines in enumerate((_NOTICES, _VERSIONS, _NAMES, _HINTS)):
        for line in lines.strip().splitlines():
            label, keyword, pattern = (part.strip() for part in line.split(" | "))
            if rank == HINT and label == "other":
                pattern = pattern.removesuffix(" (?:the )?(?:terms of )?(?:the )?") + "(?: the)?(?: terms of)?(?: the)?"
            rules.append(Rule(rank, label, keyword, pattern.replace("{v}", "(?:version |v(?:ersion)? ?)?")))
    # An SPDX identifier names any of the labels above, also with only or or-later after it.
    for label in sorted({rule.label for rule in rules if rule.rank <= VERSION}):
        words = " ".join(filter(None, "".join(c if c.isalnum() else " " for c in label).split()))
        rules.append(Rule(NOTICE, label, "spdx license identifier", f"spdx license identifier {words}(?: only| or later)?"))
    return rules


RULES = _rules()


def words_of(text: Column) -> Column:
    """The words in lower case, a space before each."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(plain == "", "").otherwise(F.concat(F.lit(" "), plain))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column, rules: list[Rule]) -> Column:
    """All matches of the rules whose keyword occurs, as (start, -end, rank, rule, label, base)."""
    table = F.array(*[
        F.struct(F.lit(rule.rank).alias("rank"), F.lit(i).alias("rule"), F.lit(rule.label).alias("label"),
                 F.lit(rule.keyword).alias("keyword"), F.lit(f" (?:{rule.pattern})(?= |$)").alias("pattern"),
                 F.lit(i < len(BASE_PHRASES)).alias("base"))
        for i, rule in enumerate(rules)])
    active = F.filter(table, lambda rule: F.contains(words, F.concat(F.lit(" "), rule["keyword"])))

    def places(rule):
        matches = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
        between = F.split(words, rule["pattern"], -1)
        pairs = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches,
                           lambda gap, match: F.struct(_spaces(gap).alias("gap"), _spaces(match).alias("length")))
        nothing = F.array().cast("array<struct<start:int,back:int,rank:int,rule:int,label:string,base:boolean>>")
        begin = F.struct(F.lit(0).alias("at"), nothing.alias("found"))

        def add(state, pair):
            start = state["at"] + pair["gap"]
            end = start + pair["length"]
            return F.struct(end.alias("at"), F.array_append(state["found"], F.struct(
                start.alias("start"), (-end).alias("back"), rule["rank"].alias("rank"), rule["rule"].alias("rule"),
                rule["label"].alias("label"), rule["base"].alias("base"))).alias("found"))

        return F.when(F.size(matches) > 0, F.aggregate(pairs, begin, add, lambda state: state["found"])).otherwise(nothing)

    return F.array_sort(F.flatten(F.transform(active, places)))


def _standing(found: Column) -> Column:
    """The detections that no other one suppresses; ``found`` is sorted by start, then longest, rank, rule.

    The furthest end so far is kept for each rank, so one pass over the sorted
    detections decides.
    """
    ranks = range(len(CONFIDENCE))
    nothing = F.array().cast("array<struct<start:int,back:int,rank:int,rule:int,label:string,base:boolean>>")
    begin = F.struct(*[F.lit(-1).alias(f"end{r}") for r in ranks], nothing.alias("kept"))

    def add(state, item):
        end = -item["back"]
        covered = F.coalesce(*[
            F.when(item["rank"] == r, F.greatest(*[state[f"end{i}"] for i in range(r + 1)], F.lit(-1)) >= end)
            for r in ranks])
        return F.struct(
            *[F.when(item["rank"] == r, F.greatest(state[f"end{r}"], end)).otherwise(state[f"end{r}"]).alias(f"end{r}")
              for r in ranks],
            F.when(covered & ~item["base"], state["kept"]).otherwise(F.array_append(state["kept"], item)).alias("kept"))

    return F.aggregate(found, begin, add, lambda state: state["kept"])


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[Rule] | None = None) -> DataFrame:
    """One row per row: ``id``, ``n_words`` and ``detections`` (start, end, label, rank, base) that stand."""
    rules = RULES if rules is None else rules
    keywords = sorted({rule.keyword for rule in rules})
    # A keyword that contains another one from the beginning of a word need not be looked for.
    keywords = [k for k in keywords if not any(other != k and f" {other}" in f" {k}" for other in keywords)]
    rows = pick(df, {"id": id_col, "text": text_col}).select("id", words_of(F.col("text")).alias("words"))
    words = F.col("words")
    gate = F.lit(False)
    for keyword in keywords:
        gate = gate | F.contains(words, F.lit(f" {keyword}"))
    found = F.when(gate, _standing(_detections(words, rules)))
    # The generator keeps the words from being computed once per use.
    rows = rows.select("id", F.inline(F.array(F.struct(words.alias("words")))))
    rows = rows.select("id", _spaces(words).cast("long").alias("n_words"), found.alias("found"))
    return rows.select("id", "n_words", F.transform(
        F.coalesce("found", F.array().cast(rows.schema["found"].dataType)),
        lambda item: F.struct(item["start"].alias("start"), (-item["back"]).alias("end"), item["label"].alias("label"),
                              item["rank"].alias("rank"), item["base"].alias("base"))).alias("detections"))


def license_digest(df: DataFrame) -> DataFrame:
    """The contract's row per document."""
    scanned = scan_licenses(df).select("id", "n_words", F.inline(F.array(F.struct(
        F.col("detections").alias("all"), F.filter("detections", lambda d: d["base"]).alias("base")))))
    starts = F.transform("base", lambda d: d["start"].cast("long"))

    def labels(column):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda d: d["label"]))), ",")

    confidence = F.array_max(F.transform("all", lambda d: F.coalesce(*[
        F.when(d["rank"] == rank, F.lit(value)) for rank, value in enumerate(CONFIDENCE)])))
    return scanned.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("all").alias("labels"),
        F.coalesce(confidence, F.lit(0.0)).alias("score"))
