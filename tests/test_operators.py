import json

from pyspark.sql import functions as F

from fleetmatch.operators.coverage import coverage_metrics, coverage_summary, delete_keys, stale_keys, upsert
from fleetmatch.operators.dedupe import first_wins
from fleetmatch.operators.nested import flatten
from fleetmatch.operators.validate import validate_contacts, validate_devices, validate_sessions
from fleetmatch.schemas import endpoint_inventory, remote_inventory
from fleetmatch.sinks.csv_text import csv_line
from fleetmatch.sources.logs import log_line


def test_stale_and_kept_make_up_the_previous_table(spark):
    previous = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "hostname string, v int")
    current = spark.createDataFrame([("B", 20), ("D", 40)], "hostname string, v int")
    stale = stale_keys(previous, current)
    kept = delete_keys(previous, stale)
    assert {r.hostname for r in stale.collect()} == {"A", "C"}
    assert {r.hostname for r in kept.collect()} == {"B"}
    assert {tuple(r) for r in upsert(previous, current).collect()} == {("A", 1), ("B", 20), ("C", 3), ("D", 40)}
    once = upsert(kept, current)
    assert {tuple(r) for r in upsert(once, current).collect()} == {tuple(r) for r in once.collect()}


def test_summary_counts_unknown_in_total_only(spark):
    a, b = remote_inventory(), endpoint_inventory()
    coverage = spark.createDataFrame([("FULL_COVERAGE",), ("UNKNOWN",), ("REMOTE_ONLY",)], "coverage_status string")
    assert tuple(coverage_summary(coverage, a, b).first()) == (3, 1, 1, 0)
    metrics = coverage_metrics(coverage_summary(coverage.limit(0), a, b), a, b).orderBy("position").collect()
    assert [(m.Metric, m.Count) for m in metrics] == [
        ("Total Devices", "0"), ("Full Coverage", "0"), ("Remote Only", "0"), ("Endpoint Only", "0"),
        ("Coverage Percentage", "NaN%")]


def test_csv_line_tells_null_from_empty(spark):
    df = spark.createDataFrame([('a,b', 'say "x"', 'two\nlines', None, "", 5)],
                               "a string, b string, c string, d string, e string, f int")
    line = df.select(csv_line([F.col(c) for c in df.columns])).first()[0]
    assert line == '"a,b","say ""x""","two\nlines",,"","5"'


def test_log_line_extra_field_replaces_base_field(spark):
    line = spark.range(1).select(log_line(F.lit("t"), F.lit("INFO"), F.lit("m"),
                                          {"level": F.lit("WARN"), "n": F.lit(None)})).first()[0]
    assert line == '{"timestamp":"t","level":"WARN","message":"m","n":null}'


def test_flatten(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('b', 2, 'c', named_struct('d', 3, 'e', array(4))) AS a,
        'early' AS a_b, named_struct('x.y', 5) AS `p q`, map('k', 1) AS m,
        CAST(NULL AS STRUCT<z: INT>) AS gone""")
    flat = flatten(df)
    assert flat.columns == ["id", "a_b", "a_c_d", "a_c_e", "p q_x.y", "m", "gone_z"]
    assert tuple(flat.first()) == (1, "early", 3, [4], 5, {"k": 1}, None)


def errors(df):
    return [(row.valid, row.errors) for row in df.collect()]


def test_contacts(spark):
    df = spark.createDataFrame([
        (1, None, "a@b.co", "+1 (555) 010-99"), (0, "", "a@b", "12345"), (None, "c", "a b@c.de", ""),
        (None, None, "", None), (2, None, "x@y.z\n", "555-0100-99x"), (3, None, "a@b .c", "5550100999 "),
    ], "id bigint, contactId string, email string, phone string")
    no_id, email, phone = ("Contact must have an id or contactId", "Contact email is invalid",
                           "Contact phone format is invalid")
    assert errors(validate_contacts(df)) == [
        (True, []), (False, [no_id, email, phone]), (False, [email]), (False, [no_id]), (False, [email, phone]),
        (False, [email])]
    assert errors(validate_contacts(df.select("email").limit(1))) == [(False, [no_id])]


def test_sessions(spark):
    df = spark.createDataFrame([
        ("s", None, "2024-01-01", None), ("", "x", "2024-01-01T00:00:00Z", "later"), (None, None, None, ""),
    ], "id string, sessionId string, startTime string, endTime string")
    assert errors(validate_sessions(df)) == [
        (True, []), (False, ["Session endTime must be a valid date"]),
        (False, ["Session must have an id or sessionId", "Session must have a valid startTime"])]


def test_devices(spark):
    no_id, name = "Device must have an id or deviceId", "Device name must be a string"
    online, activity = "Device isOnline must be a boolean", "Device lastActivity must be a valid date"
    cases = [
        ({"id": "1", "name": "n", "isOnline": True, "lastActivity": "2024-01-01"}, []),
        ({"id": 0, "deviceId": ""}, [no_id]), ({"id": False, "deviceId": 0.5}, []), ({"id": []}, []),
        ({"id": 1, "name": 0}, []), ({"id": 1, "name": 1}, [name]), ({"id": 1, "name": True}, [name]),
        ({"id": 1, "name": {}}, [name]), ({"id": 1, "isOnline": None}, [online]),
        ({"id": 1, "isOnline": "true"}, [online]), ({"id": 1, "isOnline": False}, []),
        ({"id": 1, "lastActivity": ""}, []), ({"id": 1, "lastActivity": "x"}, [activity]),
        ({"id": 1, "lastActivity": None}, []), ({}, [no_id]),
    ]
    texts = [(i, json.dumps(record)) for i, (record, _) in enumerate(cases)]
    texts += [(100, "no json"), (101, "[1]"), (102, "7"), (103, None)]
    got = validate_devices(spark.createDataFrame(texts, "i int, record string"), "record").orderBy("i").collect()
    assert [row.errors for row in got[:len(cases)]] == [expected for _, expected in cases]
    assert [row.errors for row in got[len(cases):]] == [["Record is not a JSON object"]] * 4


def test_first_wins_without_an_order_and_with_odd_names(spark):
    rows = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 2, "z"), ("c", 2, "v"), ("c", 1, "w")],
                                 "`the.key` string, `kept.order` int, kept string")
    found = sorted(tuple(row) for row in first_wins(rows, ["the.key"], "kept.order").collect())
    assert found == [("a", None, "x"), ("b", 2, "z"), ("c", 1, "w")]
