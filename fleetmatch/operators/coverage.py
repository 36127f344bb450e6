"""Stale keys, upsert, and the match of both inventories."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.functions import percentage_text
from fleetmatch.schemas import InventorySpec
from fleetmatch.session import iso_text

FULL = "FULL_COVERAGE"


def stale_keys(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Hostnames stored before that the current export does not list."""
    return previous.select("hostname").join(current.select("hostname"), "hostname", "left_anti")


def delete_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys.select("hostname"), "hostname", "left_anti")


def upsert(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert or replace whole rows by hostname."""
    return delete_keys(table, rows).unionByName(rows)


def match_coverage(a: DataFrame, b: DataFrame, spec_a: InventorySpec, spec_b: InventorySpec,
                   run_ts: datetime) -> DataFrame:
    """One row per hostname of either inventory (each unique by hostname).

    A full outer equi-join. Inventories that come straight from first-wins are
    already partitioned and sorted by hostname, so it adds no exchange.
    """
    left = a.select("hostname", "description", F.col("status").alias("status_a"),
                    F.col("last_seen").alias("last_seen_a"), F.lit(True).alias("seen_a"))
    right = b.select("hostname", F.col("status").alias("status_b"), F.lit(True).alias("seen_b"))
    seen_a, seen_b = F.col("seen_a").isNotNull(), F.col("seen_b").isNotNull()
    return left.join(right, "hostname", "full_outer").select(
        "hostname",
        "description",
        seen_a.cast("int").alias("in_a"),
        seen_b.cast("int").alias("in_b"),
        "status_a",
        "status_b",
        "last_seen_a",
        F.when(seen_b, F.lit(iso_text(run_ts))).alias("last_seen_b"),
        F.when(seen_a & seen_b, FULL).when(seen_a, spec_a.only_status)
        .when(seen_b, spec_b.only_status).otherwise("UNKNOWN").alias("coverage_status"),
    )


def refresh_coverage(previous: DataFrame, changed: DataFrame, a: DataFrame, b: DataFrame, spec_a: InventorySpec,
                     spec_b: InventorySpec, run_ts: datetime) -> DataFrame:
    """The match of two inventories, from an earlier one and the hostnames changed since.

    Only the changed hostnames are matched again. The other rows are carried over;
    a host of B was seen by this run, as in a full match.
    """
    keys = changed.select("hostname").distinct()
    fresh = match_coverage(a.join(keys, "hostname", "left_semi"), b.join(keys, "hostname", "left_semi"),
                           spec_a, spec_b, run_ts)
    seen_b = F.when(F.col("in_b") == 1, F.lit(iso_text(run_ts)))
    kept = previous.join(keys, "hostname", "left_anti").withColumn("last_seen_b", seen_b)
    return kept.select(fresh.columns).unionByName(fresh)


def all_hostnames(a: DataFrame, b: DataFrame) -> DataFrame:
    """Hostnames of either inventory, once each, sorted."""
    return a.select("hostname").union(b.select("hostname")).distinct().orderBy("hostname")


def _yes_no(flag: str):
    return F.when(F.col(flag) != 0, "Yes").otherwise("No")


def coverage_report_rows(coverage: DataFrame) -> DataFrame:
    """Hostname, description, Yes or No per system, and status; not sorted."""
    return coverage.select("hostname", "description", _yes_no("in_a").alias("in_a"),
                           _yes_no("in_b").alias("in_b"), "coverage_status")


def coverage_report(coverage: DataFrame) -> DataFrame:
    """The report by status descending, then hostname."""
    return coverage_report_rows(coverage).orderBy(F.desc("coverage_status"), "hostname")


def report_headings(spec_a: InventorySpec, spec_b: InventorySpec) -> dict[str, str]:
    # Headings of the exported report.
    return {
        "hostname": "hostname",
        "description": "computerDescription",
        "in_a": f"In {spec_a.label}",
        "in_b": f"In {spec_b.label}",
        "coverage_status": "Coverage Status",
    }


REPORT_ORDER = (("coverage_status", "desc"), ("hostname", "asc"))


def coverage_by_status(coverage: DataFrame) -> DataFrame:
    counts = coverage.groupBy("coverage_status").agg(F.count(F.lit(1)).alias("devices"))
    return counts.orderBy(F.desc("devices"), "coverage_status")


def coverage_summary(coverage: DataFrame, spec_a: InventorySpec, spec_b: InventorySpec) -> DataFrame:
    """One row of counts, zeros where a status does not occur."""
    status = F.col("coverage_status")
    return coverage.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == FULL).alias("full_coverage"),
        F.count_if(status == spec_a.only_status).alias("a_only"),
        F.count_if(status == spec_b.only_status).alias("b_only"),
    )


def coverage_metrics(summary: DataFrame, spec_a: InventorySpec, spec_b: InventorySpec) -> DataFrame:
    """The summary as five Metric and Count rows, numbered by ``position``."""
    # Metric names of the exported summary.
    metrics = [
        ("Total Devices", F.col("total").cast("string")),
        ("Full Coverage", F.col("full_coverage").cast("string")),
        (f"{spec_a.label} Only", F.col("a_only").cast("string")),
        (f"{spec_b.label} Only", F.col("b_only").cast("string")),
        ("Coverage Percentage", percentage_text(F.col("full_coverage"), F.col("total"))),
    ]
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias("Metric"), value.alias("Count"))
        for i, (name, value) in enumerate(metrics)
    ])
    return summary.select(F.inline(rows))


SUMMARY_HEADINGS = {"Metric": "Metric", "Count": "Count"}
SUMMARY_ORDER = (("position", "asc"),)
