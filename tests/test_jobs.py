import os
"""Imports, coverage, exports and the event log over a store."""

import shutil
from datetime import datetime

import pytest

from fleetmatch.operators.coverage import match_coverage, stale_keys
from fleetmatch.plans.jobs import CoverageJobs
from fleetmatch.schemas import endpoint_inventory, remote_inventory
from fleetmatch.sources.logs import append_log, read_log, read_recent, recent
from tests.conftest import plan_of

DAY = [datetime(2024, 1, day) for day in range(1, 10)]


def write(folder, name, lines):
    path = folder / name
    path.write_text("\n".join(lines))
    return str(path)


def file_a(folder, *hosts, name="a.csv"):
    return write(folder, name, ["Host Name,Computer Description", *[f"{h},about {h}" for h in hosts]])


def file_b(folder, *hosts, name="b.csv"):
    return write(folder, name, ["hostname,status", *[f"{h},online" for h in hosts]])


@pytest.fixture
def jobs(spark, tmp_path):
    return CoverageJobs(spark, str(tmp_path / "store"))


def statuses(jobs):
    return {row.hostname: row.coverage_status for row in jobs.coverage().collect()}


def text_of(folder):
    parts = sorted(path for path in folder.iterdir() if path.name.startswith("part-"))
    return "".join(path.read_text() for path in parts)


def test_import_match_report_export(jobs, tmp_path):
    devices = jobs.run(DAY[0], file_a(tmp_path, "p1", "p2", 'p"3'), file_b(tmp_path, "p2", "p4"))
    assert devices == 4
    assert statuses(jobs) == {"P1": "REMOTE_ONLY", "P2": "FULL_COVERAGE", 'P"3': "REMOTE_ONLY",
                              "P4": "ENDPOINT_ONLY"}
    assert [row.hostname for row in jobs.report().collect()] == ['P"3', "P1", "P2", "P4"]
    assert tuple(jobs.summary().first()) == (4, 1, 2, 1)

    jobs.export(DAY[0], "both", str(tmp_path / "coverage"))
    assert text_of(tmp_path / "coverage_report.csv") == (
        '"hostname","computerDescription","In Remote","In Endpoint","Coverage Status"\n'
        '"P""3","about p""3","Yes","No","REMOTE_ONLY"\n'
        '"P1","about p1","Yes","No","REMOTE_ONLY"\n'
        '"P2","about p2","Yes","Yes","FULL_COVERAGE"\n'
        '"P4",,"No","Yes","ENDPOINT_ONLY"\n')
    assert text_of(tmp_path / "coverage_summary.csv") == (
        '"Metric","Count"\n"Total Devices","4"\n"Full Coverage","1"\n"Remote Only","2"\n'
        '"Endpoint Only","1"\n"Coverage Percentage","25.0%"\n')


def test_default_export_names(jobs, tmp_path, monkeypatch):
    jobs.run(DAY[0], file_a(tmp_path, "p1"))
    seen = []
    monkeypatch.setattr("fleetmatch.plans.jobs.write_csv_text", lambda rows, h, o, path, **k: seen.append(path))
    assert jobs.export(DAY[0]) == ["coverage_report_2024-01-01.csv", "coverage_summary_2024-01-01.csv"] == seen
    with pytest.raises(ValueError):
        jobs.export(DAY[0], "everything")


def test_sync_removes_stale_and_logs(jobs, tmp_path):
    jobs.run(DAY[0], file_a(tmp_path, "p1", "p2", "p3"))
    result = jobs.sync(file_a(tmp_path, "p2", "p9", name="a2.csv"), jobs.spec_a, DAY[1])
    assert (result.imported, result.stale) == (2, 2)
    again = jobs.sync(file_a(tmp_path, "p2", "p9", name="a2.csv"), jobs.spec_a, DAY[2])
    assert (again.imported, again.stale) == (2, 0)
    events = [(e.system, e.action, e.message, e.records_processed)
              for e in jobs.events().orderBy("event_ts", "action").collect()]
    assert events == [
        ("Coverage", "calculate", "Calculated coverage for 3 devices", 3),
        ("Remote", "import", "Imported 3 devices", 3),
        ("Remote", "delete_stale", "Deleted 2 stale devices", 2),
        ("Remote", "import", "Imported 2 devices", 2),
        ("Remote", "import", "Imported 2 devices", 2),
    ]
    assert jobs.store.commits().count() == 4


def test_an_export_without_usable_rows_empties_the_inventory(jobs, tmp_path):
    jobs.run(DAY[0], file_a(tmp_path, "p1", "p2"))
    empty = write(tmp_path, "bad.csv", ["hostname,name", ".local,x", "single"])
    with pytest.raises(ValueError, match="at least 1 expected"):
        jobs.sync(empty, jobs.spec_a, DAY[1], min_rows=1)
    assert jobs.store.read("inventory_a", jobs.spec_a.schema).count() == 2
    assert jobs.sync(empty, jobs.spec_a, DAY[2]).stale == 2
    assert jobs.calculate_coverage(DAY[2]) == 0
    assert jobs.summary().first()["total"] == 0
    jobs.export_report(DAY[2], str(tmp_path / "none.csv"))
    assert text_of(tmp_path / "none.csv") == ""


def test_a_failed_run_leaves_the_snapshot(jobs, tmp_path):
    jobs.run(DAY[0], file_a(tmp_path, "p1", "p2"))
    with pytest.raises(ValueError):
        jobs.sync(write(tmp_path, "nohost.csv", ["name,os", "a,b"]), jobs.spec_a, DAY[1])
    staged = jobs.store.read("inventory_a", jobs.spec_a.schema).limit(1)
    jobs.store.stage("inventory_a", "20240102T000000000000", staged, jobs.spec_a.schema)
    assert jobs.store.current_run("inventory_a") == "20240101T000000000000"
    assert jobs.store.read("inventory_a", jobs.spec_a.schema).count() == 2
    with pytest.raises(ValueError, match="not newer"):
        jobs.sync(file_a(tmp_path, "p1"), jobs.spec_a, DAY[0].replace(year=2023))


def test_systems_by_name(spark, tmp_path):
    jobs = CoverageJobs(spark, str(tmp_path / "named"), remote_inventory("Alpha"), endpoint_inventory("Beta"))
    jobs.run_named("ALPHA", DAY[0], file_a(tmp_path, "p1"))
    jobs.run_named("beta", DAY[1], file_b(tmp_path, "p2"))
    assert statuses(jobs) == {"P1": "ALPHA_ONLY", "P2": "BETA_ONLY"}
    jobs.run_named("both", DAY[2], file_a(tmp_path, "p1"), file_b(tmp_path, "p1"))
    assert statuses(jobs) == {"P1": "FULL_COVERAGE"}
    assert jobs.coverage().first()["last_seen_b"] == "2024-01-03T00:00:00.000Z"
    with pytest.raises(ValueError, match="unknown system"):
        jobs.run_named("gamma", DAY[3], "x")


def test_bucketed_store_joins_without_a_shuffle(spark, tmp_path):
    hosts = [f"h{i}" for i in range(300)]
    root = str(tmp_path / "bucketed")
    jobs = CoverageJobs(spark, root, buckets=8)
    jobs.run(DAY[0], file_a(tmp_path, *hosts[:200]), file_b(tmp_path, *hosts[100:]))
    result = jobs.sync(file_a(tmp_path, *hosts[50:250], name="a2.csv"), jobs.spec_a, DAY[1])
    assert (result.imported, result.stale) == (200, 50)
    jobs.calculate_coverage(DAY[1])
    assert tuple(jobs.summary().first()) == (250, 150, 50, 50)

    for table in spark.catalog.listTables():
        if table.name.startswith("fleetmatch_"):
            spark.sql(f"DROP TABLE {table.name}")  # external: the files stay
    later = CoverageJobs(spark, root)  # learns the buckets from the commits
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        a = later.store.read("inventory_a", later.spec_a.schema)
        b = later.store.read("inventory_b", later.spec_b.schema)
        matched = match_coverage(a, b, later.spec_a, later.spec_b, DAY[1])
        assert {tuple(row) for row in matched.collect()} == {tuple(row) for row in later.coverage().collect()}
        assert "SortMergeJoin" in plan_of(matched) and "Exchange" not in plan_of(matched)
        assert "Exchange" not in plan_of(stale_keys(a, b))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert later.run(DAY[2], export_b=file_b(tmp_path, "h60", name="b2.csv")) == 200


def test_first_coverage_of_an_empty_store(jobs):
    assert jobs.calculate_coverage(DAY[0]) == 0


def test_log_dataset_tail(spark, tmp_path):
    path = str(tmp_path / "log")
    for part in range(3):
        lines = spark.range(part * 10, part * 10 + 10, 1, 1).selectExpr(
            """to_json(named_struct('timestamp', 't', 'level', 'INFO', 'message', concat('m', id), 'k', id)) AS line""")
        append_log(lines, path, f"2024-01-0{part + 1}")
    last = recent(read_log(spark, path), "line_order", lines=3).collect()
    assert [row.message for row in last] == ["m27", "m28", "m29"]
    assert last[0].extra == {"k": "27"}


def test_log_tail_does_not_depend_on_when_files_were_finished(spark, tmp_path):
    path = str(tmp_path / "log")
    for append in (1, 0):  # the later append is written first
        lines = spark.range(append * 8, append * 8 + 8).repartition(4).selectExpr(
            "id", "to_json(named_struct('message', concat('t', lpad(id, 3, '0')))) AS line")
        append_log(lines, path, f"run-{append}", "id")
    append_log(spark.range(8, 16).selectExpr(
        "id", "to_json(named_struct('message', concat('t', lpad(id, 3, '0')))) AS line"), path, "run-1", "id")
    for age, file in enumerate(sorted((tmp_path / "log").rglob("part-*"), reverse=True)):
        os.utime(file, (10 ** 9 + age, 10 ** 9 + age))
    log = read_log(spark, path)
    assert log.count() == 16
    assert [row.message for row in recent(log, "line_order", lines=3).collect()] == ["t013", "t014", "t015"]


def test_a_failed_run_can_be_tried_again(jobs, tmp_path):
    a, b = file_a(tmp_path, "h1", "h2"), file_b(tmp_path, "h2", "h3")
    with pytest.raises(Exception):
        jobs.run(DAY[0], a, str(tmp_path / "missing.csv"))
    assert jobs.run(DAY[0], a, b) == 3
    once = sorted(tuple(e) for e in jobs.events().collect())
    assert [e[1:3] for e in once] == [("Coverage", "calculate"), ("Endpoint", "import"), ("Remote", "import")]
    assert jobs.run(DAY[0], a, b) == 3
    assert sorted(tuple(e) for e in jobs.events().collect()) == once
    assert jobs.sync(a, jobs.spec_a, DAY[0]).imported == 2


def test_old_runs_expire(jobs, tmp_path):
    for day in DAY[:3]:
        jobs.run(day, file_a(tmp_path, "h1", "h2"))
    table = jobs.spec_a.table
    assert len(jobs.store.expire(table, keep=2)) == 1 and jobs.store.expire(table, keep=2) == []
    assert jobs.store.read(table, jobs.spec_a.schema).count() == 2
    with pytest.raises(ValueError):
        jobs.store.expire(table, keep=0)


def test_run_times_and_rejects(jobs, tmp_path, spark):
    first = jobs.sync(file_a(tmp_path, "p1", "p2", "p2.corp", ".corp"), jobs.spec_a, DAY[0])
    assert (first.imported, first.duplicates, first.rejected) == (2, 1, 1)
    jobs.run(DAY[1], file_a(tmp_path, "p2", "p3"), file_b(tmp_path, "p2"))
    rows = jobs.inventory(jobs.spec_a, run_times=True).collect()
    assert {(r.hostname, r.imported_at, r.updated_at) for r in rows} == {("P2", DAY[1], DAY[1]), ("P3", DAY[1], DAY[1])}
    assert {r.last_updated for r in jobs.coverage(run_times=True).collect()} == {DAY[1]}
    assert [(r.table_name, r.line, r.rejected_at) for r in jobs.rejects().collect()] == [
        ("inventory_a", ".corp,about .corp", DAY[0])]
    # A retry finds the same counts; a failed first try leaves no rejects twice.
    again = CoverageJobs(spark, jobs.store.root).sync("/nowhere", jobs.spec_a, DAY[0])
    assert again == first
    assert "imported_at" not in jobs.inventory(jobs.spec_a).columns


def test_other_domains_and_lengths(spark, tmp_path):
    rules = {"suffixes": (".example.org".upper(), "-OLD"), "hostname_length": 6}
    jobs = CoverageJobs(spark, str(tmp_path / "store"), remote_inventory("Remote", **rules),
                        endpoint_inventory("Endpoint", **rules))
    jobs.run(DAY[0], file_a(tmp_path, "web1.example.org", "db-7-old", "long-name-1", "x.corp"),
             file_b(tmp_path, "WEB1", "db-7", "LONG-NAME-2", "x"))
    assert statuses(jobs) == {"WEB1": "FULL_COVERAGE", "DB-7": "FULL_COVERAGE", "LONG-N": "FULL_COVERAGE",
                              "X.CORP": "REMOTE_ONLY", "X": "ENDPOINT_ONLY"}


def test_a_tail_opens_the_newest_appends_only(spark, tmp_path):
    path = str(tmp_path / "log")
    for number in range(6):
        lines = spark.createDataFrame([(i, f'{{"level": "INFO", "message": "{number}-{i}"}}') for i in range(4)], "i int, line string")
        append_log(lines.where("i < 0") if number == 4 else lines, path, f"run-{number}", "i")
    tail = read_recent(spark, path, lines=6)
    assert [r.message for r in tail.collect()] == ["3-2", "3-3", "5-0", "5-1", "5-2", "5-3"]
    assert {f.split("append_id=")[1][:5] for f in tail.inputFiles()} == {"run-3", "run-4", "run-5"}  # run-4 is empty
    assert [r.value for r in tail.collect()] == [
        r.value for r in recent(read_log(spark, path), "line_order", lines=6).collect()]
    # An append whose lines were not counted is opened too; fewer lines than asked for are all lines.
    shutil.rmtree(tmp_path / "log" / "_counts" / "append_id=run-5")
    assert [r.message for r in read_recent(spark, path, lines=3).collect()] == ["5-1", "5-2", "5-3"]
    assert read_recent(spark, path, lines=100).count() == 20
