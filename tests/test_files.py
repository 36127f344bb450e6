"""File handling, one rule per test."""

from datetime import datetime

import pytest

from fleetmatch.operators.inventory import TOO_FEW_FIELDS, UNUSABLE_HOSTNAME, parse_inventory, parse_with_rejects
from fleetmatch.schemas import endpoint_inventory, remote_inventory
from fleetmatch.sources.delimited import EMPTY_EXPORT, read_export, resolve_layout, split_header

RUN_TS = datetime(2024, 1, 31, 12)
ROWS = [("wks-1", "Windows 11", "10.0.0.1"), ("WKS-2.corp", "ubuntu", " 10.0.0.2 ")]


def write(tmp_path, text, name="export.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def imported(spark, path, spec=None):
    spec = spec or remote_inventory()
    rows = parse_inventory(read_export(spark, path), spec, RUN_TS).orderBy("hostname").collect()
    return [row.asDict() for row in rows]


@pytest.mark.parametrize("delimiter", [",", "\t", ";"])
def test_delimiters(spark, tmp_path, delimiter):
    lines = [("Host Name", "OS Type", "IP Address"), *ROWS]
    got = imported(spark, write(tmp_path, "\n".join(delimiter.join(line) for line in lines)))
    assert [(r["hostname"], r["platform"], r["ip_address"]) for r in got] == [
        ("WKS-1", "Windows", "10.0.0.1"), ("WKS-2", "Linux", "10.0.0.2")]
    assert {r["last_seen"] for r in got} == {"2024-01-31T12:00:00.000Z"}
    assert {r["description"] for r in got} == {None}


def test_semicolon_wins_a_tie_with_tab(spark):
    layout = resolve_layout(spark, "id;hostname;a\tb\tc", remote_inventory())
    assert layout.delimiter == ";"


def test_bom_crlf_blank_lines_and_lone_cr(spark, tmp_path):
    text = "﻿hostname,name\r\n\r\n \t \r\n \nwks-1,a\rb\r\nwks-2, c \r\n"
    got = imported(spark, write(tmp_path, text))
    assert [(r["hostname"], r["description"]) for r in got] == [("WKS-1", "a\rb"), ("WKS-2", "c")]


def test_ragged_rows(spark, tmp_path):
    text = "hostname,os,ip,name\nonly-host\nshort,linux\nlong,linux,1,d,e,f\ntrail,,,\n.local,x\n,linux\n"
    got = {r["hostname"]: r for r in imported(spark, write(tmp_path, text))}
    assert set(got) == {"SHORT", "LONG", "TRAIL"}
    assert got["SHORT"]["description"] is None and got["SHORT"]["ip_address"] is None
    assert got["LONG"]["description"] == "d"
    assert got["TRAIL"]["description"] == "" and got["TRAIL"]["platform"] == "UNKNOWN"


def test_first_row_wins(spark, tmp_path):
    text = "hostname,name\nwks-1,one\nWKS-1.corp,two\n wks-1.local ,three\nwks-2,x\n"
    got = imported(spark, write(tmp_path, text))
    assert [(r["hostname"], r["description"], r["source_rows"]) for r in got] == [
        ("WKS-1", "one", 3), ("WKS-2", "x", 1)]


def test_alias_priority_differs_between_systems(spark, tmp_path):
    text = "id,hostname,os\nx1,h1,linux\n"
    assert imported(spark, write(tmp_path, text))[0]["hostname"] == "H1"
    assert imported(spark, write(tmp_path, text), endpoint_inventory())[0]["hostname"] == "X1"


def test_quotes_are_ordinary_characters(spark, tmp_path):
    text = 'hostname,name\n"wks-1",say "a\\"\n"wks,2",b\n'
    got = {r["hostname"]: r["description"] for r in imported(spark, write(tmp_path, text))}
    assert got == {'"WKS-1"': 'say "a\\"', '"WKS': '2"'}


def test_header_text_repeated_in_the_data_is_a_row(spark, tmp_path):
    text = "hostname,name\nwks-1,a\nhostname,name\n"
    got = {r["hostname"]: r["description"] for r in imported(spark, write(tmp_path, text))}
    assert got == {"WKS-1": "a", "HOSTNAME": "name"}


def test_missing_hostname_column(spark, tmp_path):
    with pytest.raises(ValueError, match="must have a hostname column"):
        imported(spark, write(tmp_path, "name,os\na,b\n"))


@pytest.mark.parametrize("text", ["", "\n \n", "hostname,name\n", "hostname,name\n\n  \n"])
def test_no_data(spark, tmp_path, text):
    with pytest.raises(ValueError, match=EMPTY_EXPORT):
        imported(spark, write(tmp_path, text))


def test_status_words(spark, tmp_path):
    words = ["1", "true", "YES", "Online", "active", "0", "FALSE", "no", "offline", "Inactive", "", "normal"]
    text = "hostname,status,os version,version\n" + "".join(f"h{i},{w}, 10 ,7.1\n" for i, w in enumerate(words))
    got = {r["hostname"]: r["status"] for r in imported(spark, write(tmp_path, text), endpoint_inventory())}
    assert [got[f"H{i}"] for i in range(12)] == ["Online"] * 5 + ["Offline"] * 5 + ["Unknown", "Normal"]


def test_part_files_are_one_export_in_name_order(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    write(folder, "hostname,name\nwks-2,from b\nwks-3,from b\n", "part-b.csv")
    write(folder, "hostname,name\n\nwks-1,from a\nwks-2,from a\n", "part-a.csv")
    got = {r["hostname"]: r["description"] for r in imported(spark, str(folder))}
    assert got == {"WKS-1": "from a", "WKS-2": "from a", "WKS-3": "from b"}


def test_each_part_file_has_its_own_layout(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder, "hostname,name,last seen\nwks-1,a,2024-01-05\nwks-2,first,x\n", "a.csv")
    write(folder, "\nName;x;Computer\nfrom b;,;wks-2\nfrom b;;wks-3\nlone\n", "b.csv")
    write(folder, "os\tid\nlinux\twks-4\nwindows\twks-1\n", "c.csv")
    write(folder, "\n \n", "d.csv")
    export = read_export(spark, str(folder))
    assert len(export.headers) == 3
    got = {r["hostname"]: r for r in imported(spark, str(folder))}
    assert {name: (r["description"], r["platform"], r["last_seen"], r["source_rows"]) for name, r in got.items()} == {
        "WKS-1": ("a", "UNKNOWN", "2024-01-05", 2), "WKS-2": ("first", "UNKNOWN", "x", 2),
        "WKS-3": ("from b", "UNKNOWN", "2024-01-31T12:00:00.000Z", 1),
        "WKS-4": (None, "Linux", "2024-01-31T12:00:00.000Z", 1)}
    rows = parse_with_rejects(export, remote_inventory(), RUN_TS).collect()
    assert [(r.reject_reason, r.reject_line) for r in rows if r.reject_reason] == [(TOO_FEW_FIELDS, "lone")]
    assert sum(r.source_rows for r in rows) == 7


def test_a_part_file_without_a_hostname_is_named(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder, "hostname,name\nwks-1,a\n", "a.csv")
    write(folder, "nobody;os\nb;c\n", "b.csv")
    with pytest.raises(ValueError, match="hostname column.*nobody;os"):
        imported(spark, str(folder))


def test_files_of_one_header_need_no_header_numbers(spark, tmp_path):
    folder = tmp_path / "same"
    folder.mkdir()
    for name in "ab":
        write(folder, f"hostname,name\nwks-{name},x\n", f"{name}.csv")
    export = read_export(spark, str(folder))
    assert not export.headers and export.lines.columns == ["value", "row_order"]
    assert [r.row_order.file for r in export.lines.orderBy("row_order").collect()] == [0, 1]


def test_rejects_and_records_are_all_lines(spark, tmp_path):
    text = "hostname,os,ip,name\nonly-host\nshort,linux\n\nSHORT.corp,x\n.local,x\n,linux\n,\nonly-host\n"
    export = read_export(spark, write(tmp_path, text))
    rows = parse_with_rejects(export, remote_inventory(), RUN_TS).collect()
    assert sorted((r.reject_reason, r.reject_line) for r in rows if r.reject_reason) == [
        (TOO_FEW_FIELDS, "only-host"), (TOO_FEW_FIELDS, "only-host"), (UNUSABLE_HOSTNAME, ","),
        (UNUSABLE_HOSTNAME, ",linux"), (UNUSABLE_HOSTNAME, ".local,x")]
    assert [(r.hostname, r.source_rows) for r in rows if not r.reject_reason] == [("SHORT", 2)]
    plain = parse_inventory(export, remote_inventory(), RUN_TS)
    kept = [r for r in rows if not r.reject_reason]
    assert [tuple(r) for r in plain.collect()] == [tuple(r)[:len(plain.columns)] for r in kept]


def test_many_splits_keep_file_order(spark, tmp_path):
    rows = 20000
    text = "hostname,name\n" + "".join(f"wks-{i % 500},row {i}\n" for i in range(rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
        export = read_export(spark, write(tmp_path, text))
        assert export.lines.rdd.getNumPartitions() > 8
        got = parse_inventory(export, remote_inventory(), RUN_TS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert {r["hostname"]: r["description"] for r in got} == {f"WKS-{i}": f"row {i}" for i in range(500)}
    assert {r["source_rows"] for r in got} == {rows // 500}


def test_blank_unicode_lines_before_the_header(spark, tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    (folder / "a.csv").write_text("\u00a0\n\u2003\nhostname,os\nh1,x\n\nhostname,os\n", encoding="utf-8")
    (folder / "b.csv").write_text("hostname,os\nh2,y\n", encoding="utf-8")
    export = read_export(spark, str(folder))
    assert export.header == "hostname,os"
    rows = [row.value for row in export.lines.orderBy("row_order").collect()]
    assert rows == ["h1,x", "hostname,os", "h2,y"]
    (folder / "c.csv").write_text("\u2003\nname;os;id\nh2;y;h3\n", encoding="utf-8")
    export = read_export(spark, str(folder))
    assert export.headers == ("hostname,os", "name;os;id")
    rows = [(row.value, row.header_no) for row in export.lines.orderBy("row_order").collect()]
    assert rows == [("h1,x", 0), ("hostname,os", 0), ("h2,y", 0), ("h2;y;h3", 1)]


def test_unclear_order_of_lines_is_refused(spark):
    for orders in ([1, 1, 2], [None, 1, 2], [None, None]):
        lines = spark.createDataFrame([(f"line {i}", o) for i, o in enumerate(orders)], "value string, place int")
        with pytest.raises(ValueError, match="place"):
            split_header(lines, "place")
