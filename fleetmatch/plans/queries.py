"""One query per operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.functions import (
    format_bytes,
    normalize_email,
    normalize_hostname,
    normalize_phone,
    normalize_platform,
    normalize_status,
    normalize_string,
    parse_iso_date,
    percentage_text,
    seconds_to_duration,
    trim_or_null,
)
from fleetmatch.operators.batches import assign_batches, map_batches
from fleetmatch.operators.coverage import (
    REPORT_ORDER,
    SUMMARY_HEADINGS,
    SUMMARY_ORDER,
    all_hostnames,
    coverage_by_status,
    coverage_metrics,
    coverage_report,
    coverage_report_rows,
    coverage_summary,
    delete_keys,
    match_coverage,
    report_headings,
    stale_keys,
    upsert,
)
from fleetmatch.operators.dedupe import duplicate_counts, first_wins
from fleetmatch.operators.events import event_rows, import_counts_of
from fleetmatch.operators.inventory import (
    TOO_FEW_FIELDS,
    UNUSABLE_HOSTNAME,
    parse_inventory,
    parse_rows,
    truncation_collisions,
)
from fleetmatch.operators.nested import collect_groups, flatten, flatten_open
from fleetmatch.operators.projection import select_once
from fleetmatch.operators.stats import duration_stats
from fleetmatch.operators.validate import (
    constraint_audit,
    validate_contacts,
    validate_devices,
    validate_sessions,
)
from fleetmatch.plans import fixtures as fx
from fleetmatch.plans.jobs import CoverageJobs
from fleetmatch.session import run_id_of, scratch_path
from fleetmatch.sinks.csv_text import csv_lines
from fleetmatch.sources.delimited import detect_delimiter, field_positions, read_export
from fleetmatch.sources.logs import append_log, log_line, read_log, read_recent, recent

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEC_A, SPEC_B, RUN_TS = fx.SPEC_A, fx.SPEC_B, fx.RUN_TS


def query(function: Query) -> Query:
    """Register under the function's name, without a trailing underscore."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def current_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_inventory(fx.export_a(spark, sf_dir), SPEC_A, RUN_TS)


def current_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_inventory(fx.export_b(spark, sf_dir), SPEC_B, RUN_TS)


def stored_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_inventory(fx.previous_a(spark, sf_dir), SPEC_A, RUN_TS)


def stored_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_inventory(fx.previous_b(spark, sf_dir), SPEC_B, RUN_TS)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, for several readers."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_coverage(current_a(spark, sf_dir), current_b(spark, sf_dir), SPEC_A, SPEC_B, RUN_TS)


def inventory_columns(df: DataFrame) -> DataFrame:
    """Stored columns without the parsed timestamp, which repeats last_seen."""
    return df.drop("last_seen_ts")


# --- sources -----------------------------------------------------------------

@query
def ingest_lines(spark, sf_dir):
    return fx.export_b(spark, sf_dir).lines.select(F.col("row_order").alias("line_no"), "value")


@query
def detect_delimiter_(spark, sf_dir):
    texts = [("documents", "doc_id", "text"), ("pages", "page_id", "html"), ("benchmark", "item_id", "text")]
    parts = [
        fx.table(spark, sf_dir, name).select(F.lit(name).alias("origin"), F.col(key).alias("id"),
                                             detect_delimiter(F.col(text)).alias("delimiter"))
        for name, key, text in texts
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query
def resolve_columns(spark, sf_dir):
    headers = fx.derived(spark, sf_dir, "events", {"event_id": "event_id", "header": fx.HEADER_VARIANTS})
    found = field_positions(headers, "header", SPEC_A, SPEC_B)
    names = {f"{SPEC_A.table}.": "a_", f"{SPEC_B.table}.": "b_"}
    return found.select("event_id", "delimiter", *[
        F.col(f"`{name}`").alias(name.replace(table, short))
        for table, short in names.items() for name in found.columns if name.startswith(table)
    ])


@query
def parse_inventory_(spark, sf_dir):
    parsed = current_a(spark, sf_dir)
    return parsed.withColumn("last_seen_ts", F.date_format("last_seen_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def parse_inventory_b(spark, sf_dir):
    return current_b(spark, sf_dir)


@query
def import_mixed_forms(spark, sf_dir):
    """One export in files of three forms, each with its own delimiter, names and order of columns."""
    export = read_export(spark, fx.write_forms(spark, sf_dir))
    return inventory_columns(parse_inventory(export, SPEC_A, RUN_TS))


# --- snapshots ---------------------------------------------------------------

@query
def stale_devices(spark, sf_dir):
    return stale_keys(stored_a(spark, sf_dir), current_a(spark, sf_dir))


@query
def stale_hosts(spark, sf_dir):
    return stale_keys(stored_b(spark, sf_dir), current_b(spark, sf_dir))


@query
def delete_stale(spark, sf_dir):
    stored = stored_b(spark, sf_dir)
    return delete_keys(stored, stale_keys(stored, current_b(spark, sf_dir)))


@query
def snapshot_upsert(spark, sf_dir):
    return inventory_columns(upsert(stored_a(spark, sf_dir), current_a(spark, sf_dir)))


@query
def snapshot_sync(spark, sf_dir):
    """Two runs through the snapshot store; the second replaces the first."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.sync(fx.previous_b(spark, sf_dir), SPEC_B, RUN_TS - timedelta(days=1))
    jobs.sync(fx.export_b(spark, sf_dir), SPEC_B, RUN_TS)
    return jobs.store.read(SPEC_B.table, SPEC_B.schema)


@query
def merged_coverage(spark, sf_dir):
    """Three imports that write only changed buckets, and a coverage rebuilt from what changed."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"), merge_buckets=16)
    jobs.run(RUN_TS - timedelta(days=2), fx.export_a(spark, sf_dir, fx.dealt), fx.previous_b(spark, sf_dir, fx.dealt))
    jobs.run(RUN_TS - timedelta(days=1), export_b=fx.export_b(spark, sf_dir, fx.dealt))
    jobs.run(RUN_TS, fx.export_a(spark, sf_dir, fx.dealt), fx.export_b(spark, sf_dir, fx.dealt))
    return jobs.coverage()


@query
def stored_changes(spark, sf_dir):
    """How the rows of B differ between two runs, from the buckets that the runs do not share."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"), merge_buckets=16)
    jobs.sync(fx.previous_b(spark, sf_dir), SPEC_B, RUN_TS - timedelta(days=1))
    jobs.sync(fx.export_b(spark, sf_dir), SPEC_B, RUN_TS)
    return jobs.store.changes(SPEC_B.table, run_id_of(RUN_TS - timedelta(days=1)), run_id_of(RUN_TS))


@query
def stored_run_times(spark, sf_dir):
    """When the rows that two imports and a match leave in the store were written."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.run(RUN_TS - timedelta(days=1), fx.previous_a(spark, sf_dir), fx.previous_b(spark, sf_dir))
    jobs.run(RUN_TS, export_b=fx.export_b(spark, sf_dir))

    def times(name: str, rows: DataFrame, imported: str | None, updated: str) -> DataFrame:
        shown = [F.date_format(column, "yyyy-MM-dd HH:mm:ss") if column else F.lit(None).cast("string")
                 for column in (imported, updated)]
        return rows.select(F.lit(name).alias("table_name"), "hostname", shown[0].alias("imported_at"),
                           shown[1].alias("updated_at"))

    stored = [times(spec.table, jobs.inventory(spec, run_times=True), "imported_at", "updated_at")
              for spec in (SPEC_A, SPEC_B)]
    return stored[0].union(stored[1]).union(
        times("device_coverage", jobs.coverage(run_times=True), None, "last_updated"))


@query
def rejected_lines(spark, sf_dir):
    """The lines that an import of A does not take, from its dataset of rejects."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.sync(fx.export_a(spark, sf_dir), SPEC_A, RUN_TS)
    return jobs.rejects().groupBy("table_name", "reason", "line").agg(F.count(F.lit(1)).alias("n"))


@query
def import_counts(spark, sf_dir):
    """What became of the lines of both exports, from what the imports wrote."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.sync(fx.export_a(spark, sf_dir), SPEC_A, RUN_TS)
    jobs.sync(fx.export_b(spark, sf_dir), SPEC_B, RUN_TS)
    rejects = jobs.rejects().groupBy("table_name").agg(
        F.count_if(F.col("reason") == TOO_FEW_FIELDS).alias("too_few_fields"),
        F.count_if(F.col("reason") == UNUSABLE_HOSTNAME).alias("unusable"))
    stored = [jobs.inventory(spec).agg(F.lit(spec.table).alias("table_name"), F.count(F.lit(1)).alias("stored"),
                                       F.sum(F.col("source_rows") - 1).alias("duplicates")) for spec in (SPEC_A, SPEC_B)]
    counts = stored[0].union(stored[1]).join(rejects, "table_name", "left").fillna(0)
    return counts.withColumn("lines", F.col("stored") + F.col("duplicates") + F.col("too_few_fields") + F.col("unusable"))


# --- de-duplication ----------------------------------------------------------

@query
def dedupe_first_wins(spark, sf_dir):
    orders = fx.derived(spark, sf_dir, "orders", {
        "customer": "nullif(o_custkey, 0)", "o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice",
        "o_orderpriority": "o_orderpriority",
    })
    return first_wins(orders, ["customer"], "o_orderkey")


@query
def dedupe_null_order(spark, sf_dir):
    """The first event of each user and type; users divisible by 3 have no order at all."""
    events = fx.table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.when(F.col("user_id") % 3 != 0, F.col("event_id")).alias("place.of row"),
        F.when(F.col("user_id") % 3 != 0, F.col("event_id")).otherwise(F.col("user_id")).alias("kept.value"))
    first = first_wins(events, ["user_id", "event_type"], "place.of row")
    return first.toDF("user_id", "event_type", "place", "kept_value")


@query
def dedupe_counts(spark, sf_dir):
    return duplicate_counts(parse_rows(fx.export_a(spark, sf_dir), SPEC_A)[0], ["hostname"])


@query
def hostname_collisions(spark, sf_dir):
    names = fx.derived(spark, sf_dir, "lineitem", {"host_raw": fx.RAW_A["host_raw"]})
    return truncation_collisions(names, "host_raw")


# --- coverage ----------------------------------------------------------------

@query
def coverage_match(spark, sf_dir):
    return coverage(spark, sf_dir)


@query
def coverage_hostnames(spark, sf_dir):
    return all_hostnames(current_a(spark, sf_dir), current_b(spark, sf_dir))


@query
def coverage_report_(spark, sf_dir):
    return coverage_report(coverage(spark, sf_dir))


@query
def coverage_summary_by_status(spark, sf_dir):
    return coverage_by_status(coverage(spark, sf_dir))


@query
def coverage_summary_(spark, sf_dir):
    return coverage_summary(coverage(spark, sf_dir), SPEC_A, SPEC_B)


@query
def coverage_summary_metrics(spark, sf_dir):
    return coverage_metrics(coverage_summary_(spark, sf_dir), SPEC_A, SPEC_B)


@query
def report_csv_lines(spark, sf_dir):
    return csv_lines(coverage_report_rows(coverage(spark, sf_dir)), report_headings(SPEC_A, SPEC_B), REPORT_ORDER)


@query
def summary_csv_lines(spark, sf_dir):
    return csv_lines(coverage_summary_metrics(spark, sf_dir), SUMMARY_HEADINGS, SUMMARY_ORDER)


@query
def csv_lines_any_text(spark, sf_dir):
    """Whole texts with quotes, commas and line breaks, and NULL next to empty."""
    rows = fx.derived(spark, sf_dir, "conversations", {
        "conv_id": "conv_id", "turn": "turn", "text": "text",
        "note": "CASE turn % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'say \"' || role || '\", then stop' END",
    })
    headings = {"conv_id": "Conversation", "turn": "Turn", "note": "Note", "text": "Text"}
    return csv_lines(rows, headings, (("conv_id", "asc"), ("turn", "asc")))


@query
def coverage_percentages(spark, sf_dir):
    """Percentage text for many ratios: suppliers' order lines out of 1000 and more."""
    ratios = fx.derived(spark, sf_dir, "lineitem", {
        "part": "CAST(l_partkey % (l_orderkey % 2000 + 1) AS BIGINT)",
        "total": "CAST(l_orderkey % 2000 AS BIGINT)",
    }).groupBy("part", "total").agg(F.count(F.lit(1)).alias("n"))
    return ratios.select("part", "total", "n", percentage_text(F.col("part"), F.col("total")).alias("percentage"))


# --- end to end --------------------------------------------------------------

@query
def import_both_report(spark, sf_dir):
    """Write both exports as files, import them over earlier ones, match, and report."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.run(RUN_TS - timedelta(days=1), fx.previous_a(spark, sf_dir, fx.dealt), fx.previous_b(spark, sf_dir, fx.dealt))
    jobs.run(RUN_TS, fx.write_export(fx.export_a(spark, sf_dir, fx.dealt)), fx.write_export(fx.export_b(spark, sf_dir, fx.dealt)))
    return jobs.report()


@query
def etl_event_log(spark, sf_dir):
    """Events of the second import, from one aggregate over the hostnames of all four exports."""
    sides = {"current_a": (fx.export_a, SPEC_A), "stored_a": (fx.previous_a, SPEC_A),
             "current_b": (fx.export_b, SPEC_B), "stored_b": (fx.previous_b, SPEC_B)}
    hostnames = None
    for side, (export, spec) in sides.items():
        rows = parse_rows(export(spark, sf_dir), spec)[0].select(
            "hostname", *[F.lit(side == name).alias(name) for name in sides])
        hostnames = rows if hostnames is None else hostnames.union(rows)
    rows = event_rows(import_counts_of(hostnames, SPEC_A, SPEC_B), RUN_TS, run_id_of(RUN_TS))
    return rows.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def etl_event_log_stored(spark, sf_dir):
    """The log that two imports of B leave in the store."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.run(RUN_TS - timedelta(days=1), export_b=fx.previous_b(spark, sf_dir))
    jobs.run(RUN_TS, export_b=fx.export_b(spark, sf_dir))
    return jobs.events().withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))


@query
def export_report_files(spark, sf_dir):
    """The exported report and summary, read back from their files."""
    jobs = CoverageJobs(spark, scratch_path(spark, "store"))
    jobs.run(RUN_TS, fx.export_a(spark, sf_dir), fx.export_b(spark, sf_dir))
    report, summary = jobs.export(RUN_TS, "both", scratch_path(spark, "coverage"))
    return spark.read.text(report).select(F.lit("report").alias("file"), F.col("value").alias("line")).union(
        spark.read.text(summary).select(F.lit("summary").alias("file"), F.col("value").alias("line")))


@query
def constraint_audit_(spark, sf_dir):
    """Audits of inventories that are parsed once and written, as an import writes them."""
    a = staged(current_a(spark, sf_dir), "inventory-a")
    b = staged(current_b(spark, sf_dir), "inventory-b")
    raw = fx.derived(spark, sf_dir, "customer", {
        "hostname": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END", "flag": "c_nationkey % 4"})
    return (
        constraint_audit(a, SPEC_A.table)
        .union(constraint_audit(b, SPEC_B.table))
        .union(constraint_audit(match_coverage(a, b, SPEC_A, SPEC_B, RUN_TS), "device_coverage",
                                flags=("in_a", "in_b")))
        .union(constraint_audit(a, "records_a", rows_per_key="source_rows"))
        .union(constraint_audit(raw, "customer_segments", flags=("flag",)))
    )


# --- column functions --------------------------------------------------------

@query
def normalize_hostname_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "lineitem", {"host_raw": fx.RAW_A["host_raw"]})
    return rows.select("host_raw", normalize_hostname(F.col("host_raw")).alias("hostname"))


@query
def normalize_platform_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "part", {
        "p_partkey": "p_partkey",
        "platform_raw": "CASE WHEN p_size < 25 THEN " + fx.platform_variants("p_partkey")
                        + " WHEN p_size < 49 THEN p_type || ' ' || p_name END",
    })
    return rows.select("p_partkey", "platform_raw", normalize_platform(F.col("platform_raw")).alias("platform"))


@query
def normalize_status_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "orders", {
        "o_orderkey": "o_orderkey",
        "status_raw": "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' "
                      "THEN o_orderstatus ELSE " + fx.RAW_B["status_raw"] + " END",
    })
    return rows.select("o_orderkey", "status_raw", normalize_status(F.col("status_raw")).alias("status"))


@query
def trim_fields(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "orders", {
        "o_orderkey": "o_orderkey", "os_version_raw": fx.RAW_B["os_version_raw"],
        "agent_version_raw": fx.RAW_B["agent_version_raw"],
        "ip_raw": "CASE WHEN o_orderkey % 3 = 0 THEN ' ' || chr(9) || '10.0.0.' || CAST(o_custkey AS STRING) || ' ' "
                  "WHEN o_orderkey % 3 = 1 THEN '  ' END",
    })
    return rows.select("o_orderkey", *[
        trim_or_null(F.col(f"{name}_raw")).alias(name) for name in ("os_version", "agent_version", "ip")])


@query
def clean_contacts(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "customer", fx.CONTACTS)
    return rows.select(
        "c_custkey",
        normalize_string(F.col("contactId")).alias("contact"),
        normalize_email(F.col("email")).alias("email"),
        normalize_phone(F.col("phone")).alias("phone"),
    )


@query
def clean_texts(spark, sf_dir):
    """Trim, lower-case and digits over whole documents."""
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(normalize_string(F.col("text"))).cast("bigint").alias("trimmed_length"),
        F.md5(normalize_email(F.col("source"))).alias("source_hash"),
        normalize_phone(F.col("text")).alias("digits"),
    )


@query
def parse_iso_date_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "orders", {"o_orderkey": "o_orderkey", "text": fx.DATE_VARIANTS})
    return rows.select("o_orderkey", "text", F.date_format(
        parse_iso_date(F.col("text")), "yyyy-MM-dd HH:mm:ss.SSS").alias("moment"))


@query
def seconds_to_duration_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "lineitem", {"seconds": fx.SECONDS})
    seconds = F.col("seconds")
    return select_once(rows, {  # as one projection, the generated method is too long to be compiled
        "seconds": seconds, "duration": seconds_to_duration(seconds),
        "duration_int": seconds_to_duration(seconds.cast("int")),
        "duration_double": seconds_to_duration(seconds.cast("double")),
        "duration_half": seconds_to_duration(seconds + F.lit(0.5))})


@query
def format_bytes_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "lineitem", {"bytes": fx.BYTES})
    size = F.col("bytes")
    return select_once(rows, {  # as one projection, the generated method is too long to be compiled
        "bytes": size, "text": format_bytes(size),
        "text_int": format_bytes((size % (1 << 31)).cast("int")),
        "text_double": format_bytes(size.cast("double")),
        "text_quarter": format_bytes((size % (1 << 40)) + F.lit(0.25))})


# --- validation and nested data ----------------------------------------------

def rendered(validated: DataFrame, key: str) -> DataFrame:
    return validated.select(key, "valid", F.concat_ws("; ", "errors").alias("errors"))


@query
def validate_date_forms(spark, sf_dir):
    """Sessions whose start is written in one of many forms, valid and not."""
    rows = fx.derived(spark, sf_dir, "orders", {"o_orderkey": "o_orderkey", "id": "1", "startTime": fx.ANY_DATE})
    return rendered(validate_sessions(rows), "o_orderkey")


@query
def validate_devices_(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "events", {"event_id": "event_id", "record": fx.DEVICE_JSON})
    return rendered(validate_devices(rows, "record"), "event_id")


@query
def validate_contacts_(spark, sf_dir):
    return rendered(validate_contacts(fx.derived(spark, sf_dir, "customer", fx.CONTACTS)), "c_custkey")


@query
def validate_sessions_(spark, sf_dir):
    return rendered(validate_sessions(fx.derived(spark, sf_dir, "orders", fx.SESSIONS)), "o_orderkey")


@query
def flatten_props(spark, sf_dir):
    nested = fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.struct("user_id", F.struct(F.col("event_type").alias("name")).alias("type")).alias("actor"),
        F.from_json("props", "k INT").alias("props"),
        F.lit("first").alias("actor_user"),
        F.struct(F.lit("second").alias("user"), F.array("user_id", "event_id").alias("ids")).alias("actor_"),
    )
    flat = flatten(nested.withColumnRenamed("actor_", "pair"))
    return flat.withColumn("pair_ids", F.concat_ws(",", F.col("pair_ids").cast("array<string>")))


@query
def flatten_open_props(spark, sf_dir):
    """Records whose keys differ by row; one column of the table has a name that a record could give."""
    rows = fx.derived(spark, sf_dir, "events", {"event_id": "event_id", "record": fx.OPEN_JSON, "record_k2": "'kept'"})
    return flatten_open(rows, "record", "string")


@query
def group_collect(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    groups = collect_groups(turns, "conv_id", ["turn"])
    return groups.select("conv_id", "chunk", F.size("items").cast("bigint").alias("n"), F.array_join(
        F.transform("items", lambda item: F.concat(item["role"], F.lit(": "), item["text"])), "\n").alias("talk"))


@query
def group_collect_large(spark, sf_dir):
    """Few groups with many rows each: lists continue in further chunks."""
    events = fx.derived(spark, sf_dir, "events", {
        "kind": "nullif(event_type, 'error')", "event_id": "event_id", "value": "value"})
    groups = collect_groups(events, "kind", ["event_id"])
    return groups.select("kind", "chunk", F.size("items").cast("bigint").alias("n"), F.array_join(
        F.transform("items", lambda item: item["event_id"].cast("string")), ",").alias("ids"))


# --- statistics and batches --------------------------------------------------

def rounded_stats(stats: DataFrame) -> DataFrame:
    """Sums of doubles depend on the order of addition in the last digits."""
    return stats.select("label", "count", "min", "max", F.round("avg", 6).alias("avg"),
                        "median", "p95", "p99", F.round("total", 4).alias("total"))


@query
def duration_stats_(spark, sf_dir):
    return rounded_stats(duration_stats(fx.table(spark, sf_dir, "events"), "event_type", "value"))


@query
def duration_stats_lineitem(spark, sf_dir):
    samples = fx.derived(spark, sf_dir, "lineitem", {
        "label": "nullif(l_returnflag, 'N')", "price": "l_extendedprice"})
    return rounded_stats(duration_stats(samples, "label", "price"))


@query
def batch_assign(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_batches(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index", "batch_id")


@query
def batch_map(spark, sf_dir):
    def summarise(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "n_events": [len(batch)], "first_event": [batch["event_id"].iloc[0]],
            "last_event": [batch["event_id"].iloc[-1]], "users": [batch["user_id"].nunique()],
        })

    schema = T.StructType([T.StructField(name, T.LongType())
                           for name in ("n_events", "first_event", "last_event", "users")])
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id")
    return map_batches(events, summarise, schema, ["event_id"])


# --- logs --------------------------------------------------------------------

def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = (F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "view", "DEBUG")
             .otherwise("INFO"))
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))
    return fx.table(spark, sf_dir, "events").select("event_id", log_line(
        stamp, level, F.concat(F.lit("Event "), F.col("event_type")),
        {"user": F.col("user_id"), "value": F.col("value"), "props": F.col("props"),
         "message": F.concat(F.lit("User \""), F.col("user_id").cast("string"), F.lit("\" "), F.col("event_type")),
         "parent": F.lit(None).cast("string")},
    ).alias("line"))


@query
def log_json_lines(spark, sf_dir):
    return event_log_lines(spark, sf_dir)


@query
def recent_logs(spark, sf_dir):
    log = event_log_lines(spark, sf_dir)
    return recent(log, "event_id", lines=50)


@query
def recent_logs_stored(spark, sf_dir):
    """The last lines of a log stored in two appends of several part files."""
    path = scratch_path(spark, "log")
    lines = event_log_lines(spark, sf_dir).withColumn("late", F.col("event_id") % 2 == 1)
    for late in (False, True):
        append_log(lines.where(F.col("late") == late).select("event_id", "line"), path, f"run-{int(late)}", "event_id")
    return read_recent(spark, path, lines=50).select(F.col("value").alias("line"))


@query
def log_dataset(spark, sf_dir):
    """Write the log lines, read the dataset back, and count by level."""
    path = scratch_path(spark, "log")
    append_log(event_log_lines(spark, sf_dir).select("line"), path, "run-0")
    log = read_log(spark, path)
    return log.groupBy("level").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first_seen"),
        F.max("message").alias("last_message"),
        F.count_distinct(F.element_at("extra", "user")).alias("users"),
        F.max(F.size("extra")).cast("bigint").alias("extra_fields"),
    )
