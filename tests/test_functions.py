import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from fleetmatch import functions as fn


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[1] for row in rows.select("i", function(F.col("x"))).orderBy("i").collect()]


def test_hostname(spark):
    cases = {
        None: None, "": None, "   ": "", "wks-1": "WKS-1", " wks-1.corporate.gha.com ": "WKS-1",
        "wks-1.gha.com": "WKS-1", "x.local.corp": "X", "x.corp.local": "X.CORP", ".local": "",
        "x.corp.corp": "X.CORP", "x.gha.com.corporate.gha.com": "X", "a.corp.b": "A.CORP.B",
        "abcdefghijklmnopqrs": "ABCDEFGHIJKLMNO", "abcdefghijklmno.local": "ABCDEFGHIJKLMNO",
        "x.corp\n": "X", " ﻿host ": "HOST", "x.local.": "X.LOCAL.", "xlocal": "XLOCAL",
    }
    assert apply(spark, fn.normalize_hostname, cases) == list(cases.values())


def test_hostname_suffixes_are_a_parameter(spark):
    def name(column):
        return fn.normalize_hostname(column, suffixes=("-OLD", ".ORG"), length=5)

    assert apply(spark, name, ["abcdefg.org", "pc.org-old", "pc-old.org"]) == ["ABCDE", "PC", "PC-OL"]


def test_platform(spark):
    cases = {
        None: "UNKNOWN", "": "UNKNOWN", "  ": "", "Windows Server 2019": "Windows Server", "WINDOWS 10": "Windows",
        "server windows": "Windows Server", "macOS 14": "macOS", "Mac OS X": "macOS", "Darwin": "macOS",
        "openSUSE": "Linux", "RHEL 9": "Linux", "chrome OS": "Chrome os", "server": "Server",
    }
    assert apply(spark, fn.normalize_platform, cases) == list(cases.values())


def test_status(spark):
    online = ["1", "true", "YES", " Online ", "active"]
    offline = ["0", "False", "no", "OFFLINE", "inactive"]
    other = {None: "Unknown", "": "Unknown", " ": "", "NORMAL": "Normal", "reduced mode": "Reduced mode"}
    assert apply(spark, fn.normalize_status, online) == ["Online"] * 5
    assert apply(spark, fn.normalize_status, offline) == ["Offline"] * 5
    assert apply(spark, fn.normalize_status, other) == list(other.values())


def test_cleaning(spark):
    assert apply(spark, fn.normalize_string, [None, " a ", ""]) == ["", "a", ""]
    assert apply(spark, fn.normalize_email, [None, " A@B.C "]) == ["", "a@b.c"]
    assert apply(spark, fn.normalize_phone, [None, "", "+1 (5)"]) == ["", "", "15"]
    assert apply(spark, fn.trim_or_null, [None, "", "  ", " x"]) == [None, None, "", "x"]


def test_dates(spark):
    cases = {
        "2024": "2024-01-01 00:00:00.000", "2024-05": "2024-05-01 00:00:00.000",
        "2024-05-06": "2024-05-06 00:00:00.000", "2024-05-06T10:11": "2024-05-06 10:11:00.000",
        "2024-05-06T10:11+01:00": "2024-05-06 09:11:00.000", "2024-05-06T10:11Z": "2024-05-06 10:11:00.000",
        "2024-05-06 10:11:12": "2024-05-06 10:11:12.000", "2024-05-06T10:11:12.5Z": "2024-05-06 10:11:12.500",
        "2024-05-06T10:11:12.123999-05:30": "2024-05-06 15:41:12.123",
        "2024-05-06T10:11:12+01:75": None, "2024-02-30": None, "2024-13-01": None, "12:30": None, "": None,
        None: None, "soon": None, "2024-05-06T25:00:00": None, "2024-05-06\n": None, "20240506": None,
    }

    def text(column):
        return F.date_format(fn.parse_iso_date(column), "yyyy-MM-dd HH:mm:ss.SSS")

    assert apply(spark, text, cases) == list(cases.values())


def test_dates_do_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        moment = apply(spark, lambda c: fn.parse_iso_date(c).cast("string"), ["2024-03-10T02:30:00", "2024-01-01"])
        assert moment == ["2024-03-10 02:30:00", "2024-01-01 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_durations(spark):
    cases = {0: "N/A", None: "N/A", 59: "59s", 60: "1m", 3600: "1h", 3661: "1h 1m 1s", 7205: "2h 5s", -5: "0s",
             -4000: "0s", 360000: "100h"}
    assert apply(spark, fn.seconds_to_duration, cases, "bigint") == list(cases.values())


def test_bytes(spark):
    cases = {0: "0.00 B", 1023: "1023.00 B", -5: "-5.00 B", 1024: "1.00 KB", 1536: "1.50 KB", 1048575: "1024.00 KB",
             1048576: "1.00 MB", 5 * 1024**3: "5.00 GB", 3 * 1024**4: "3072.00 GB", None: None,
             (1 << 62): "4294967296.00 GB", 1029: "1.00 KB", 1030: "1.01 KB"}
    assert apply(spark, fn.format_bytes, cases, "bigint") == list(cases.values())


def exact_percentage(part, total):
    if total == 0:
        return "NaN%"
    return f"{Decimal(part / total * 100).quantize(Decimal('0.1'), ROUND_HALF_UP)}%"


def test_percentages_round_the_exact_double(spark):
    pairs = [(p, t) for t in range(0, 160) for p in range(0, t + 1)]
    chosen = random.Random(1)
    pairs += [(chosen.randrange(t + 1), t) for t in (chosen.randrange(1, 10**9) for _ in range(3000))]
    pairs += [(1, 3 * 10**9), (0, 5), (5, 5), (23, 80)]
    rows = spark.createDataFrame(pairs, "part bigint, total bigint")
    got = rows.select("part", "total", fn.percentage_text(F.col("part"), F.col("total"))).collect()
    assert [(p, t, text) for p, t, text in got if text != exact_percentage(p, t)] == []


def test_keys_are_short_and_upper_case(spark):
    chosen = random.Random(2)
    letters = "aB.-corplghm9 é"
    names = ["".join(chosen.choice(letters) for _ in range(chosen.randrange(30))) for _ in range(500)]
    for key in apply(spark, fn.normalize_hostname, names):
        assert key is None or (len(key) <= 15 and key == key.upper())


@pytest.mark.parametrize("function", [fn.normalize_status, fn.normalize_platform, fn.normalize_email])
def test_null_never_stays_null(spark, function):
    assert apply(spark, function, [None])[0] is not None
