"""Event-log rows from run counts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.schemas import InventorySpec
from fleetmatch.session import iso_text


def import_counts_of(hostnames: DataFrame, spec_a: InventorySpec, spec_b: InventorySpec) -> DataFrame:
    """What an import of both systems and a match process, for ``event_rows``, from one aggregate.

    ``hostnames`` may repeat; the flags ``current_a``, ``stored_a``, ``current_b`` and
    ``stored_b`` tell where each comes from. A hostname is reduced to one row in
    each task first.
    """
    flags = ("current_a", "stored_a", "current_b", "stored_b")
    merged = hostnames.groupBy("hostname").agg(*[F.max(flag).alias(flag) for flag in flags])
    here_a, was_a, here_b, was_b = map(F.col, flags)
    counts = [(spec_a.label, "delete_stale", spec_a.noun, was_a & ~here_a), (spec_a.label, "import", spec_a.noun, here_a),
              (spec_b.label, "delete_stale", spec_b.noun, was_b & ~here_b), (spec_b.label, "import", spec_b.noun, here_b),
              ("Coverage", "calculate", "devices", here_a | here_b)]
    totals = merged.agg(*[F.count_if(condition).alias(f"n{i}") for i, (*_, condition) in enumerate(counts)])
    rows = F.array(*[F.struct(F.lit(system).alias("system"), F.lit(action).alias("action"), F.lit(noun).alias("noun"),
                              F.col(f"n{i}").alias("records_processed"))
                     for i, (system, action, noun, _) in enumerate(counts)])
    return totals.select(F.inline(rows))


def event_rows(counts: DataFrame, run_ts: datetime, run_id: str) -> DataFrame:
    """Log rows for counts of (system, action, noun, records_processed).

    Actions are delete_stale, import and calculate; a delete_stale of nothing is
    not logged.
    """
    n = F.col("records_processed")
    text = n.cast("string")
    # The message texts.
    message = (
        F.when(F.col("action") == "delete_stale",
               F.concat(F.lit("Deleted "), text, F.lit(" stale "), F.col("noun")))
        .when(F.col("action") == "import", F.concat(F.lit("Imported "), text, F.lit(" "), F.col("noun")))
        .otherwise(F.concat(F.lit("Calculated coverage for "), text, F.lit(" "), F.col("noun")))
    )
    return counts.where((F.col("action") != "delete_stale") | (n > 0)).select(
        F.lit(iso_text(run_ts)[:-1]).cast("timestamp_ntz").alias("event_ts"),
        "system",
        "action",
        F.lit("SUCCESS").alias("status"),
        message.alias("message"),
        n.cast("bigint").alias("records_processed"),
        F.lit(run_id).alias("run_id"),
    )
