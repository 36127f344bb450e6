"""Runs that share unchanged buckets, and coverage rebuilt from changes."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetmatch.operators.coverage import match_coverage
from fleetmatch.plans.jobs import CoverageJobs
from fleetmatch.session import run_id_of
from fleetmatch.sources.delimited import split_header

START = datetime(2024, 3, 1)


def export(spark, header, rows):
    lines = [header, *[",".join(row) for row in rows], ",nothing"]
    return split_header(spark.createDataFrame(list(enumerate(lines)), "n int, value string"), "n")


def data_files(jobs, table):
    return {str(p) for p in Path(jobs.store.root, table).rglob("*.parquet")}


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_random_sequences_equal_a_full_rebuild(spark, tmp_path):
    rng = random.Random(4)
    merged = CoverageJobs(spark, str(tmp_path / "merged"), merge_buckets=8)
    plain = CoverageJobs(spark, str(tmp_path / "plain"))
    hosts = {}
    for day in range(4):
        moment = START + timedelta(days=day)
        for host in rng.sample(range(40), 6):
            hosts[f"h{host}"] = rng.choice(["x", "y", ""])
        for host in rng.sample(sorted(hosts), min(len(hosts), 2)):
            hosts.pop(host)
        side = export(spark, "hostname,name,last seen", [(h, f"about {v}", "2024-01-05") for h, v in hosts.items()])
        other = export(spark, "hostname,status", [(h, v) for h, v in hosts.items() if hash(h) % 3 or day == 3])
        given = {"export_a": side if day != 2 else None, "export_b": other if day != 1 else None}
        for jobs in (merged, plain):
            jobs.run(moment, **given)
        for times in (False, True):
            assert rows_of(merged.coverage(times)) == rows_of(plain.coverage(times))
            for spec in (merged.spec_a, merged.spec_b):
                assert rows_of(merged.inventory(spec, times)) == rows_of(plain.inventory(spec, times))
    runs = [run_id_of(START + timedelta(days=d)) for d in (0, 3)]
    names = [{r.hostname for r in merged.store.read_run("inventory_a", run, merged.spec_a.schema).collect()} for run in runs]
    found = {r.hostname: r.change for r in merged.store.changes("inventory_a", *runs).collect()}
    assert {h for h, c in found.items() if c == "stale"} == names[0] - names[1]
    assert {h for h, c in found.items() if c == "inserted"} == names[1] - names[0]
    # A full match of the stored inventories gives the same.
    full = match_coverage(merged.inventory(merged.spec_a), merged.inventory(merged.spec_b), merged.spec_a, merged.spec_b,
                          START + timedelta(days=3))
    assert rows_of(full) == rows_of(merged.coverage())


def test_an_equal_export_writes_no_data(spark, tmp_path):
    jobs = CoverageJobs(spark, str(tmp_path / "store"), merge_buckets=8)
    rows = [(f"host{i}", "online", f"7.{i}") for i in range(200)]
    jobs.sync(export(spark, "hostname,status,version", rows), jobs.spec_b, START)
    before, first = data_files(jobs, "inventory_b"), rows_of(jobs.inventory(jobs.spec_b))
    result = jobs.sync(export(spark, "hostname,status,version", rows), jobs.spec_b, START + timedelta(days=1))
    assert (result.imported, result.stale, result.rejected) == (200, 0, 1)
    assert data_files(jobs, "inventory_b") == before and len(before) == 8
    assert rows_of(jobs.inventory(jobs.spec_b)) == first
    assert {r.updated_at for r in jobs.inventory(jobs.spec_b, run_times=True).collect()} == {START + timedelta(days=1)}
    # One changed row rewrites its bucket alone.
    rows[5] = ("host5", "online", "8.0")
    jobs.sync(export(spark, "hostname,status,version", rows), jobs.spec_b, START + timedelta(days=2))
    assert len(data_files(jobs, "inventory_b") - before) == 1
    changes = jobs.store.changes("inventory_b", run_id_of(START), run_id_of(START + timedelta(days=2)))
    assert [tuple(r) for r in changes.collect()] == [("HOST5", "changed")]


def test_nulls_that_change_places_are_changes(spark, tmp_path):
    jobs = CoverageJobs(spark, str(tmp_path / "store"), merge_buckets=2)
    jobs.sync(export(spark, "hostname,os version,agent version", [("h", "x", "")]), jobs.spec_b, START)
    jobs.sync(export(spark, "hostname,os version,agent version", [("h", "", "x")]), jobs.spec_b, START + timedelta(days=1))
    assert [(r.os_version, r.agent_version) for r in jobs.inventory(jobs.spec_b).collect()] == [(None, "x")]


def test_an_emptied_inventory_and_retries(spark, tmp_path):
    jobs = CoverageJobs(spark, str(tmp_path / "store"), merge_buckets=4)
    jobs.run(START, export_b=export(spark, "hostname,status", [("a", "x"), ("b", "y")]))
    jobs.run(START + timedelta(days=1), export_b=export(spark, "hostname,status", []))
    assert jobs.inventory(jobs.spec_b).count() == 0 and jobs.coverage().count() == 0
    jobs.run(START + timedelta(days=2), export_b=export(spark, "hostname,status", [("c", "x")]))
    assert [r.hostname for r in jobs.coverage().collect()] == ["C"]
    # Staged but not committed: the next try replaces it.
    late = START + timedelta(days=3)
    jobs.store.stage("inventory_b", run_id_of(late), jobs.inventory(jobs.spec_b, True).where("false"), jobs.spec_b.stored_schema)
    jobs.run(late, export_b=export(spark, "hostname,status", [("c", "x"), ("d", "z")]))
    assert sorted(r.hostname for r in jobs.coverage().collect()) == ["C", "D"]
    with pytest.raises(ValueError, match="not newer"):
        jobs.store.stage("inventory_b", run_id_of(START + timedelta(hours=1)), jobs.inventory(jobs.spec_b, True),
                         jobs.spec_b.stored_schema)


def test_expired_runs_keep_the_buckets_others_name(spark, tmp_path):
    jobs = CoverageJobs(spark, str(tmp_path / "store"), merge_buckets=4)
    for day in range(3):
        rows = [(f"h{i}", "x") for i in range(20)] + [("new", str(day))]
        jobs.run(START + timedelta(days=day), export_b=export(spark, "hostname,status", rows))
    wanted = rows_of(jobs.inventory(jobs.spec_b))
    first = run_id_of(START)
    assert jobs.store.expire("inventory_b", 1) and rows_of(jobs.inventory(jobs.spec_b)) == wanted
    assert jobs.store.changes("inventory_b", first, run_id_of(START + timedelta(days=2))) is None
    assert len(data_files(jobs, "inventory_b")) == 4
    # Without the earlier run the coverage is matched in full.
    jobs.run(START + timedelta(days=4), export_b=export(spark, "hostname,status", [("z", "x")]))
    assert [r.hostname for r in jobs.coverage().collect()] == ["Z"]
