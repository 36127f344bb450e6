import hashlib
import random
import re

import pytest

from fleetmatch.llm import pii
from tests.llm.helpers import by_id, documents, no_documents, odd_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(p) > 255 for p in match.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, match.start(), match.end()))
    return found


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(7)
    parts = ["a", "B", "1", "4", "0", ".", "-", " ", "@", "+", "%", "(", ")", "é", "255.", "12.", "4111 1111 1111 1111",
             "\n", "x.y", "://", "token="]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        spans = [(pii.KINDS[k], a, b) for k, a, b in pii.find_spans(text) if k < 4]
        assert spans == brute(text), text


@pytest.mark.parametrize("text, kind, value", [
    ("see https://user.example.org/a?b=1.", "url", "https://user.example.org/a?b=1"),
    ('token = "abcdef0123456789"', "secret", "abcdef0123456789"),
    ("IBAN: DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00"),
    ("SSN 123-45-6789", "account", "123-45-6789"),
    ("account no. 12345678", "account", "12345678"),
])
def test_added_kinds(text, kind, value):
    assert (kind, value) in [(pii.KINDS[k], text[a:b]) for k, a, b in pii.find_spans(text)]


def test_an_iban_with_a_wrong_check_number_is_none():
    assert not [s for s in pii.find_spans("IBAN DE88 3704 0044 0532 0130 00") if pii.KINDS[s[0]] == "account"]


@pytest.mark.parametrize("text", ["1" * 300000, "a@" * 100000, "1." * 100000, "+1(" * 100000, "://" * 100000, "@" * 100000])
def test_time_grows_with_the_text(text):
    pii.find_spans(text)


def test_digest_of_odd_rows(spark):
    text = "mail a.b@c.de or +1 (555) 123-4567"
    frame = pii.pii_digest(odd_documents(spark).union(documents(spark, [(20, text)])))
    rows = by_id(frame)
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[2] == [(0, 0, 0, 0, nothing, "")] and len(rows[1]) == 2 and len(rows[None]) == 1
    written = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
    assert rows[20] == [(1, 0, 0, 1, hashlib.sha256(written.encode()).hexdigest(), written)]
    assert pii.pii_digest(no_documents(spark)).count() == 0


def test_redaction_keeps_rows_and_columns(spark):
    docs = documents(spark, [(1, "write to a@b.cd, please"), (2, None), (3, "clean"), (4, "+1 555 123 4567 1.2.3.4")])
    clean = pii.redact_pii(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    rows = {row[0]: (row[1], row[4]) for row in clean.collect()}
    assert rows[1] == ("write to [EMAIL], please", 24) and rows[3] == ("clean", 5) and rows[2] == (None, 0)
    assert "555" not in rows[4][0]
    assert all(not pii.find_spans(text) for text, _ in rows.values())


@pytest.mark.parametrize("text, kind, value", [
    *[(f"{cue}: abcdef0123456789", "secret", "abcdef0123456789")
      for cue in ("API key", "API Key", "Api_Key", "ApiKey", "é API KEY", "İ aPi_kEy", "PassWord")],
    ("IBAN BE68 5390 0754 7034 BIC KREDBEBB", "account", "BE68 5390 0754 7034"),
    ("IBAN BE68 5390 0754 7034 AB", "account", "BE68 5390 0754 7034"),
    ("iban: DE89370400440532013000 BLZ 1", "account", "DE89370400440532013000"),
    ("IBAN NO93 8601 1117 947 EUR", "account", "NO93 8601 1117 947"),
])
def test_written_forms_of_cues_and_words_after_an_iban(text, kind, value):
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in pii.find_spans(text) if pii.KINDS[k] == kind] == [(kind, value)]
