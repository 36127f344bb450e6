"""From export lines to de-duplicated inventory records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmatch.functions import full_hostname, normalize_hostname, trim
from fleetmatch.functions.normalize import HOSTNAME_LENGTH
from fleetmatch.operators.dedupe import first_wins
from fleetmatch.operators.projection import select_once
from fleetmatch.schemas import InventorySpec
from fleetmatch.sources.delimited import Export, Layout, resolve_layouts


TOO_FEW_FIELDS = "too few fields"
UNUSABLE_HOSTNAME = "unusable hostname"
REJECTION = ("reject_reason", "reject_line", "reject_order")


def _by_header(values: Sequence, number: Column) -> Column:
    """The value of the line's header; a literal when all headers have the same."""
    if len(set(values)) == 1:
        return F.lit(values[0])
    return F.element_at(F.array(*map(F.lit, values)), number + 1)


def split_rows(lines: DataFrame, layouts: Sequence[Layout], keep_short: bool = False) -> DataFrame:
    """Raw fields per line, not trimmed yet; lines with a single field are skipped.

    Splitting ignores quotes. A field missing in a short line is NULL. With
    ``keep_short`` lines with a single field stay, as rows without fields; every row
    then has its line as ``value`` and whether it ``is_short``.
    """
    kept = ["row_order", *(["value"] if keep_short else []), *(["header_no"] if len(layouts) > 1 else [])]
    number = F.col("header_no") if len(layouts) > 1 else F.lit(0)
    delimiter = _by_header([layout.delimiter for layout in layouts], number)
    has_fields = F.contains("value", delimiter)
    if len(layouts) == 1:
        fields = F.split("value", layouts[0].delimiter)
    else:
        fields = F.coalesce(*[F.when(delimiter == char, F.split("value", char))
                              for char in sorted({layout.delimiter for layout in layouts})])
    if keep_short:
        fields = F.when(has_fields, fields)
    else:
        lines = lines.where(has_fields)
    if len(layouts) > 1 or keep_short:  # not to split once for each field
        lines, fields = select_once(lines, {**{name: F.col(name) for name in kept}, "fields": fields}), F.col("fields")
    kept += [fields.isNull().alias("is_short")] if keep_short else []
    positions = {field: [layout.positions[field] for layout in layouts] for field in layouts[0].positions}
    return lines.select(*kept, *[
        F.get(fields, _by_header(found, number)).alias(field)
        for field, found in positions.items() if max(found) >= 0])


def keyed_rows(raw: DataFrame, spec: InventorySpec | None = None, keep_unusable: bool = False) -> DataFrame:
    """Raw fields under the normalised hostname; rows without a usable one are dropped."""
    rules = {"suffixes": spec.suffixes, "length": spec.hostname_length} if spec else {}
    others = [name for name in raw.columns if name != "hostname"]
    keyed = select_once(raw, {"hostname": normalize_hostname(F.col("hostname"), **rules),
                              **{name: F.col(name) for name in others}})
    return keyed if keep_unusable else keyed.where(F.col("hostname") != "")


def parse_rows(export: Export, spec: InventorySpec) -> tuple[DataFrame, list[Layout]]:
    """All usable rows of an export, duplicates included, and its layouts."""
    layouts = resolve_layouts(export.lines.sparkSession, export.all_headers, spec)
    return keyed_rows(split_rows(export.lines, layouts), spec), layouts


def _records(winners: DataFrame, layouts: Sequence[Layout], spec: InventorySpec, run_ts: datetime,
             extra: Sequence[str] = ()) -> DataFrame:
    """The stored columns of the rows that won, from their raw fields."""
    fields, mapped = {}, {}
    for field in layouts[0].positions:
        numbers = [i for i, layout in enumerate(layouts) if layout.positions[field] >= 0]
        fields[field] = trim(F.col(field)) if numbers else F.lit(None).cast("string")
        some = 0 < len(numbers) < len(layouts)
        mapped[field] = F.col("header_no").isin(numbers) if some else F.lit(bool(numbers))
    columns = spec.record(fields, mapped, run_ts)
    return winners.select("hostname", *[column.alias(name) for name, column in columns.items()], "source_rows", *extra)


def parse_inventory(export: Export, spec: InventorySpec, run_ts: datetime) -> DataFrame:
    """One record per hostname, the first in the export, with its number of source rows.

    Only the key is normalised for every row; the other fields travel raw and
    are trimmed and normalised for the rows that won.
    """
    rows, layouts = parse_rows(export, spec)
    winners = first_wins(rows, ["hostname"], "row_order", rows_per_key="source_rows", keep_order=False)
    return _records(winners, layouts, spec, run_ts)


def parse_with_rejects(export: Export, spec: InventorySpec, run_ts: datetime) -> DataFrame:
    """The records of ``parse_inventory``, and a row for every line that gives none.

    ``reject_reason``, ``reject_line`` and ``reject_order`` are NULL in records. One pass
    over the lines and one shuffle make both: a rejected line is a key of its own.
    The sum of ``source_rows`` is the number of lines.
    """
    layouts = resolve_layouts(export.lines.sparkSession, export.all_headers, spec)
    rows = keyed_rows(split_rows(export.lines, layouts, keep_short=True), spec, keep_unusable=True)
    others = [name for name in rows.columns if name not in ("hostname", "value", "is_short")]
    reason = F.when(F.col("is_short"), TOO_FEW_FIELDS).when(F.coalesce("hostname", F.lit("")) == "", UNUSABLE_HOSTNAME)
    rows = rows.withColumn("reject_reason", reason)
    rejected = F.col("reject_reason").isNotNull()
    rows = rows.select(
        F.when(~rejected, F.col("hostname")).alias("hostname"), "reject_reason",
        F.when(rejected, F.col("value")).alias("reject_line"), F.when(rejected, F.col("row_order")).alias("reject_order"),
        *others)
    winners = first_wins(rows, ["hostname", "reject_reason", "reject_order"], "row_order", rows_per_key="source_rows",
                         keep_order=False)
    return _records(winners, layouts, spec, run_ts, REJECTION)


def truncation_collisions(names: DataFrame, hostname: str) -> DataFrame:
    """Keys under which cutting to NetBIOS length merged different machines.

    Two-step distinct: the names of a key are reduced to a count, never listed.
    """
    full = select_once(names, {"full_name": full_hostname(F.col(hostname))}).where(F.col("full_name") != "")
    per_name = full.groupBy("full_name").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_name.groupBy(F.substring("full_name", 1, HOSTNAME_LENGTH).alias("hostname"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_names"), F.sum("n").alias("total_rows"),
    ).where(F.col("distinct_names") > 1)
