"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over each text and reports anchors: at-signs,
scheme marks, plus signs, digits and identifier cues. Each anchor is handed to a
small deterministic parser that expands it to both sides, decides where the item
ends and validates it. Every parser is linear in the text it looks at, so very
long texts and long runs of anchors cost no more than their length.

Spans are ``kind:start:end`` in code points, the end exclusive, leftmost and
non-overlapping per kind; spans of different kinds may overlap (a run of digits
can be both a card and part of a phone number). A null text counts as empty. A
row without spans keeps its row with an empty list. Rows are independent, so
repeated rows and repeated or null ids give repeated results; an empty table
gives an empty result. Other columns do not matter.

The base kinds are email, ip, card and phone. The method adds ``account`` (IBAN
with a valid check number, social security and account numbers after their cue),
``secret`` (the value after a cue such as ``token =``) and ``url``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import numbered, pick, pieces, position_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("account", "secret", "url")
_CODE = {kind: code for code, kind in enumerate(KINDS)}

# The words that announce an identifier, by the parser they lead to.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access_key")
ACCOUNT_CUES = ("iban", "ssn", "account")

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ZONE = re.compile(r"[0-9. -]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`]+")
_SECRET = re.compile(r"[\"']?[ \t]{0,8}[:=][ \t]{0,8}[\"']?([A-Za-z0-9_./+=-]{8,})")
_IBAN = re.compile(r"[ :#]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
# The length of an IBAN by its country.
_IBAN_LENGTHS = {country: int(length) for length, *countries in map(str.split, """15 NO|16 BE|18 DK FI FK FO GL NL SD
    19 MK SI|20 AT BA EE KZ LT LU MN XK|21 CH HR LI LV|22 BG BH CR DE GB GE IE ME RS VA|23 AE GI IL IQ OM SO TL
    24 AD CZ ES MD PK RO SA SE SK TN VG|25 LY PT ST|26 IS TR|27 BI DJ FR GR IT MC MR SM
    28 AL AZ BY CY DO GT HN HU LB NI PL SV|29 BR EG PS QA UA|30 JO KW MU YE|31 MT SC|32 LC|33 RU""".replace("\n", "|").split("|"))
    for country in countries}
_IBAN_OF = {country: re.compile(rf"[ :#]{{0,3}}({country}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{length // 4 - 1}}}"
                                + (f" ?[A-Z0-9]{{{length % 4}}}" if length % 4 else "") + ")(?![A-Za-z0-9])")
            for country, length in _IBAN_LENGTHS.items()}
_UPPER = re.compile("[A-Z]+")
_COUNTRY = re.compile("[ :#]{0,3}([A-Z]{2})")
_SSN = re.compile(r"[ :#]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?:[ _]?(?:no\.?|number))?[ :#=]{1,3}([0-9]{6,18})(?![0-9])")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", (1, "email", ""))
    anchors.add_word("+", (1, "phone", ""))
    anchors.add_word("://", (3, "url", ""))
    for digit in "0123456789":
        anchors.add_word(digit, (1, "digit", ""))
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            anchors.add_word(cue, (len(cue), kind, cue))
    anchors.make_automaton()
    return anchors


def _lowered(text: str) -> str:
    """The text with ASCII letters in lower case, so that places stay the same."""
    return text.lower() if text.isascii() else _UPPER.sub(lambda found: found.group().lower(), text)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _iban(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _addresses(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Four dotted numbers at a time; four that are out of range are used up as well."""
    for chain in _DOTTED.finditer(text, begin, end):
        parts = [m.span() for m in re.finditer("[0-9]+", chain.group())] if chain.group().count(".") >= 3 else []
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            numbers = [chain.group()[a:b].lstrip("0") for a, b in four]
            if all(len(n) <= 3 and int(n or 0) <= 255 for n in numbers):
                yield chain.start() + four[0][0], chain.start() + four[3][1]


def _cards(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text, begin, end):
        digits = run.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield run.span()


def _account(text: str, cue: str, at: int) -> tuple[int, int] | None:
    country = _COUNTRY.match(text, at) if cue == "iban" else None
    if country and country.group(1) in _IBAN_OF:  # what follows may look like a part of it
        cut = _IBAN_OF[country.group(1)].match(text, at)
        if cut and _iban(cut.group(1).replace(" ", "")):
            return cut.span(1)
    found = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[cue].match(text, at)
    if found is None:
        return None
    if cue == "iban" and not _iban(found.group(1).replace(" ", "")):
        return None
    return found.span(1)


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """All spans of one text as (kind code, start, end), by kind and start."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    ends = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended
    zone_end = 0

    def add(kind: str, start: int, end: int) -> None:
        found.append((_CODE[kind], start, end))

    for last, (length, kind, cue) in _automaton().iter(_lowered(text)):
        at = last + 1 - length
        if kind == "digit":
            if at >= zone_end:
                zone_end = _ZONE.match(text, at).end()
                for start, end in _addresses(text, at, zone_end):
                    add("ip", start, end)
                for start, end in _cards(text, at, zone_end):
                    add("card", start, end)
        elif kind == "email":
            start = at
            while start > ends["email"] and text[start - 1] in _LOCAL:
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                ends["email"] = domain.end()
                add("email", start, domain.end())
        elif kind == "phone":
            number = _PHONE.match(text, at) if at >= ends["phone"] else None
            if number:
                ends["phone"] = number.end()
                if 9 <= sum(c.isdigit() for c in number.group()) <= 15:
                    add("phone", *number.span())
        elif kind == "url":
            start = at
            while start > ends["url"] and text[start - 1] in _SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            rest = _URL_REST.match(text, last + 1) if start < at and at >= ends["url"] else None
            if rest:
                end = last + 1 + len(rest.group().rstrip(".,;:!?)]}"))
                if end > last + 1:
                    ends["url"] = end
                    add("url", start, end)
        else:
            value = None
            if at >= ends[kind] and (at == 0 or not text[at - 1].isalnum()):
                if kind == "account":
                    value = _account(text, cue, last + 1)
                else:
                    hit = _SECRET.match(text, last + 1)
                    value = hit.span(1) if hit else None
            if value:
                ends[kind] = value[1]
                add(kind, *value)
    found.sort()
    return found


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    out, done, held = [], 0, None
    for code, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if held and start < held[2]:
            held = (held[0], held[1], max(held[2], end))
            continue
        if held:
            out += [text[done:held[1]], f"[{KINDS[held[0]].upper()}]"]
            done = held[2]
        held = (code, start, end)
    if held:
        out += [text[done:held[1]], f"[{KINDS[held[0]].upper()}]"]
        done = held[2]
    return "".join([*out, text[done:]])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id`` and ``spans``, sorted by kind as listed in ``KINDS``, then start."""
    def run(batches):
        for batch in batches:
            offsets, kinds, starts, ends = [0], [], [], []
            for text in batch.column(1).to_pylist():
                for code, start, end in find_spans(text):
                    kinds.append(KINDS[code])
                    starts.append(start)
                    ends.append(end)
                offsets.append(len(kinds))
            items = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                fields=list(_SPAN_TYPE))
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["id", "spans"])

    rows = pick(df, {"id": id_col, "text": text_col})
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: run(pieces(batches, "text")), f"id {kind}, spans {SPANS}")


def redact_pii(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns, the text without its personal data.

    ``length_col``, when there is such a column, gets the new number of code
    points. A null text stays null with its length as it was.
    """
    names = df.columns
    at = position_of(df, text_col)
    length_at = position_of(df, length_col) if length_col in names else None
    rows = numbered(df)
    length_type = rows.schema[length_at].dataType.simpleString() if length_at is not None else None

    def run(batches):
        for batch in pieces(batches, f"_{at}"):
            texts = batch.column(at).to_pylist()
            clean = [None if t is None else redacted(t, s) if (s := find_spans(t)) else t for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    clean = rows.mapInArrow(run, rows.schema)
    if length_at is not None:
        length = F.when(F.col(f"_{at}").isNull(), F.col(f"_{length_at}")).otherwise(F.length(f"_{at}"))
        clean = clean.withColumn(f"_{length_at}", length.cast(length_type))
    return clean.toDF(*names)


def pii_digest(df: DataFrame) -> DataFrame:
    """The contract's row per document, from the spans of ``find_pii``."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return find_pii(df).select(
        F.col("id").alias("doc_id"), *[count(kind) for kind in BASE_KINDS],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
