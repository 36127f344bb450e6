"""Import, match and export jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmatch.operators.coverage import (
    REPORT_ORDER,
    SUMMARY_HEADINGS,
    SUMMARY_ORDER,
    coverage_metrics,
    coverage_report,
    coverage_report_rows,
    coverage_summary,
    match_coverage,
    refresh_coverage,
    report_headings,
    stale_keys,
)
from fleetmatch.operators.events import event_rows
from fleetmatch.operators.inventory import parse_with_rejects
from fleetmatch.schemas import (
    COVERAGE_SCHEMA,
    EVENT_SCHEMA,
    INPUTS_SCHEMA,
    REJECT_SCHEMA,
    STORED_COVERAGE_SCHEMA,
    InventorySpec,
    endpoint_inventory,
    remote_inventory,
)
from fleetmatch.session import run_id_of
from fleetmatch.sinks.csv_text import write_csv_text
from fleetmatch.sources.delimited import Export, read_export
from fleetmatch.sources.merged import MergedSnapshots
from fleetmatch.sources.snapshots import SnapshotStore

COVERAGE_TABLE = "device_coverage"
EVENTS_DATASET = "etl_events"
REJECTS_DATASET = "rejected_lines"
INPUTS_DATASET = "coverage_inputs"


@dataclass(frozen=True)
class SyncResult:
    """What became of an export's lines: imported + duplicates + rejected is their number."""

    imported: int
    stale: int
    duplicates: int = 0
    rejected: int = 0


class CoverageJobs:
    """The jobs over one store. Every job takes the time it stands for as ``run_ts``.

    ``buckets`` makes the store keep its tables bucketed by hostname. With
    ``merge_buckets`` a run writes only the buckets of an inventory that changed, and
    the coverage is rebuilt for the hostnames that changed since the last one.
    """

    def __init__(self, spark: SparkSession, root: str, spec_a: InventorySpec | None = None,
                 spec_b: InventorySpec | None = None, buckets: int | None = None, merge_buckets: int | None = None):
        if buckets and merge_buckets:
            raise ValueError("buckets and merge_buckets exclude each other")
        self.spark = spark
        self.store = MergedSnapshots(spark, root, merge_buckets) if merge_buckets else SnapshotStore(spark, root, buckets)
        self.spec_a = spec_a or remote_inventory()
        self.spec_b = spec_b or endpoint_inventory()

    def _log(self, table: str, counts: list[tuple[str, str, str, int]], run_ts: datetime, run_id: str) -> None:
        """The events of a run; they are written before its commit, and a retry replaces them."""
        names = ("system", "action", "noun", "records_processed")
        rows = F.array(*[
            F.struct(*[F.lit(value).alias(name) for name, value in zip(names, count)]) for count in counts])
        rows_of_counts = self.spark.range(0, 1, 1, 1).select(F.inline(rows))
        self.store.append(EVENTS_DATASET, f"{run_id}-{table}", event_rows(rows_of_counts, run_ts, run_id))

    def sync(self, source: str | Export, spec: InventorySpec, run_ts: datetime, min_rows: int = 0) -> SyncResult:
        """Make the stored inventory equal to the export: stale hosts go, the rest is replaced.

        The export is parsed once, into the new run and the rejected lines; all
        counts come from what was written. Every row gets the run's time, as it
        replaces the one before. An export without a usable row empties the
        inventory unless ``min_rows`` refuses it. A retry with the same time finds
        what was committed and does not import it again.
        """
        run_id = run_id_of(run_ts)
        done = self.store.committed_rows(spec.table, run_id)
        if done is not None:
            stale = self.events().where((F.col("run_id") == run_id) & (F.col("system") == spec.label)
                                        & (F.col("action") == "delete_stale")).agg(F.sum("records_processed")).first()
            counts = self._read_counts(self.store.read_run(spec.table, run_id, spec.stored_schema), spec, run_id)
            return SyncResult(done, stale[0] or 0, *counts)
        export = read_export(self.spark, source) if isinstance(source, str) else source
        previous = self.store.read(spec.table, spec.stored_schema)
        now = F.lit(run_ts).cast("timestamp_ntz")
        # Two tables from one pass; a lost executor's part is parsed again.
        parsed = parse_with_rejects(export, spec, run_ts).persist(StorageLevel.DISK_ONLY)
        try:
            stored = parsed.where(F.col("reject_reason").isNull()).withColumns({"imported_at": now, "updated_at": now})
            current = self.store.stage(spec.table, run_id, stored, spec.stored_schema)
            rejects = parsed.where(F.col("reject_reason").isNotNull()).select(
                F.lit(spec.table).alias("table_name"), F.lit(run_id).alias("run_id"), F.col("reject_reason").alias("reason"),
                F.col("reject_line").alias("line"), now.alias("rejected_at"))
            self.store.append(REJECTS_DATASET, f"{run_id}-{spec.table}", rejects)
        finally:
            parsed.unpersist()
        imported = current.count()
        if imported < min_rows:
            raise ValueError(f"{spec.table}: {imported} hosts in the export, at least {min_rows} expected")
        stale = stale_keys(previous, current).count()
        self._log(spec.table, [(spec.label, "delete_stale", spec.noun, stale),
                               (spec.label, "import", spec.noun, imported)], run_ts, run_id)
        self.store.commit(spec.table, run_id, imported)
        return SyncResult(imported, stale, *self._read_counts(current, spec, run_id))

    def _read_counts(self, run: DataFrame, spec: InventorySpec, run_id: str) -> tuple[int, int]:
        """Duplicates and rejected lines of a run, from what it wrote."""
        duplicates = run.agg(F.coalesce(F.sum(F.col("source_rows") - 1), F.lit(0))).first()[0]
        rejected = self.rejects().where((F.col("run_id") == run_id) & (F.col("table_name") == spec.table)).count()
        return duplicates, rejected

    def calculate_coverage(self, run_ts: datetime) -> int:
        """Match the current inventories and make the result the current coverage."""
        run_id = run_id_of(run_ts)
        done = self.store.committed_rows(COVERAGE_TABLE, run_id)
        if done is not None:
            return done
        inputs = {"run_a": self.store.current_run(self.spec_a.table), "run_b": self.store.current_run(self.spec_b.table)}
        sides = (self.inventory(self.spec_a), self.inventory(self.spec_b), self.spec_a, self.spec_b, run_ts)
        changed = self._changed_since_coverage(inputs)
        matched = match_coverage(*sides) if changed is None else refresh_coverage(self.coverage(), changed, *sides)
        matched = matched.withColumn("last_updated", F.lit(run_ts).cast("timestamp_ntz"))
        self.store.append(INPUTS_DATASET, run_id, self.spark.range(0, 1, 1, 1).select(
            F.lit(run_id).alias("run_id"), *[F.lit(run).cast("string").alias(name) for name, run in inputs.items()]))
        devices = self.store.stage(COVERAGE_TABLE, run_id, matched, STORED_COVERAGE_SCHEMA).count()
        self._log(COVERAGE_TABLE, [("Coverage", "calculate", "devices", devices)], run_ts, run_id)
        self.store.commit(COVERAGE_TABLE, run_id, devices)
        return devices

    def _changed_since_coverage(self, inputs: dict[str, str | None]) -> DataFrame | None:
        """Hostnames that changed since the current coverage was made; None if that cannot be told."""
        run_id = self.store.current_run(COVERAGE_TABLE)
        if run_id is None or not isinstance(self.store, MergedSnapshots):
            return None
        before = self.store.read_appended(INPUTS_DATASET, INPUTS_SCHEMA).where(F.col("run_id") == run_id).first()
        if before is None:
            return None
        found = []
        for name, spec in (("run_a", self.spec_a), ("run_b", self.spec_b)):
            if before[name] == inputs[name]:
                continue
            changes = before[name] and self.store.changes(spec.table, before[name], inputs[name])
            if changes is None:
                return None
            found.append(changes.select("hostname"))
        if not found:
            return self.spark.createDataFrame([], "hostname string")
        return found[0] if len(found) == 1 else found[0].union(found[1])

    def run(self, run_ts: datetime, export_a: str | Export | None = None,
            export_b: str | Export | None = None) -> int:
        """Import the exports given, then recompute the coverage."""
        if export_a is not None:
            self.sync(export_a, self.spec_a, run_ts)
        if export_b is not None:
            self.sync(export_b, self.spec_b, run_ts)
        return self.calculate_coverage(run_ts)

    def run_named(self, system: str, run_ts: datetime, *paths: str) -> int:
        """The same by system name: the label of A, the label of B, or ``both``."""
        name = system.lower()
        if name == "both" and len(paths) == 2:
            return self.run(run_ts, *paths)
        if name == self.spec_a.label.lower() and len(paths) == 1:
            return self.run(run_ts, export_a=paths[0])
        if name == self.spec_b.label.lower() and len(paths) == 1:
            return self.run(run_ts, export_b=paths[0])
        raise ValueError(f"unknown system or wrong number of paths: {system} {list(paths)}")

    def inventory(self, spec: InventorySpec, run_times: bool = False) -> DataFrame:
        """The current inventory, with ``imported_at`` and ``updated_at`` if ``run_times`` is set."""
        rows = self.store.read(spec.table, spec.stored_schema)
        return rows if run_times else rows.select(spec.schema.fieldNames())

    def coverage(self, run_times: bool = False) -> DataFrame:
        """The current coverage, with ``last_updated`` if ``run_times`` is set."""
        rows = self.store.read(COVERAGE_TABLE, STORED_COVERAGE_SCHEMA)
        return rows if run_times else rows.select(COVERAGE_SCHEMA.fieldNames())

    def rejects(self) -> DataFrame:
        """The lines that imports did not take, with the reason."""
        return self.store.read_appended(REJECTS_DATASET, REJECT_SCHEMA)

    def events(self) -> DataFrame:
        return self.store.read_appended(EVENTS_DATASET, EVENT_SCHEMA)

    def report(self) -> DataFrame:
        return coverage_report(self.coverage())

    def summary(self) -> DataFrame:
        return coverage_summary(self.coverage(), self.spec_a, self.spec_b)

    def export_report(self, run_ts: datetime, path: str | None = None) -> str:
        path = path or f"coverage_report_{run_ts:%Y-%m-%d}.csv"
        write_csv_text(coverage_report_rows(self.coverage()), report_headings(self.spec_a, self.spec_b),
                       REPORT_ORDER, path)
        return path

    def export_summary(self, run_ts: datetime, path: str | None = None) -> str:
        path = path or f"coverage_summary_{run_ts:%Y-%m-%d}.csv"
        metrics = coverage_metrics(self.summary(), self.spec_a, self.spec_b)
        write_csv_text(metrics, SUMMARY_HEADINGS, SUMMARY_ORDER, path, one_file=True)
        return path

    def export(self, run_ts: datetime, kind: str = "both", prefix: str | None = None) -> list[str]:
        """Export ``report``, ``summary`` or ``both``; returns the folders written."""
        if kind not in ("report", "summary", "both"):
            raise ValueError(f"unknown export: {kind}")
        written = []
        if kind != "summary":
            written.append(self.export_report(run_ts, f"{prefix}_report.csv" if prefix else None))
        if kind != "report":
            written.append(self.export_summary(run_ts, f"{prefix}_summary.csv" if prefix else None))
        return written
