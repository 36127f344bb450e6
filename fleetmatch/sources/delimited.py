"""Delimited text exports: lines, delimiter, header layout."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.functions import is_blank, trim
from fleetmatch.operators.projection import select_once
from fleetmatch.schemas import InventorySpec

# Fixed value: the message for an export without data.
EMPTY_EXPORT = "CSV file is empty or has no data rows"

# The CSV reader is used as a line reader: no line contains this separator or
# this quote (no character at all), and FAILFAST turns the impossible case into
# an error instead of a lost tail.
_NO_SEPARATOR = "\u0001\u0002\u0003"
_NO_QUOTE = "\uffff"

MAX_BROADCAST_FILES = 100_000  # rows of the table of files that is broadcast


@dataclass(frozen=True)
class Layout:
    """What the header line says: the delimiter and each field's position (-1 if absent)."""

    delimiter: str
    positions: dict[str, int]


@dataclass(frozen=True)
class Export:
    """Data lines as (value, row_order), without blank lines and headers.

    Files may have different headers; then ``headers`` lists them and the lines
    have a column ``header_no`` with the place of theirs.
    """

    header: str
    lines: DataFrame
    headers: tuple[str, ...] = ()

    @property
    def all_headers(self) -> tuple[str, ...]:
        return self.headers or (self.header,)


def read_export(spark: SparkSession, path: str) -> Export:
    """Read a file, or a folder of part files that each begin with a header line of their own.

    Row order is (file, split start, position in the split), with files numbered
    in the order of their paths. It travels with each row because first-wins needs
    it after any shuffle. Spark drops the header of every file itself.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    if len(text.inputFiles()) > 1:
        return _of_files(text, path)
    at_start = text.where(F.col("_metadata.file_block_start") == 0)
    # Stops at the first split that yields a line; the data is not scanned.
    first = at_start.where(~is_blank(F.col("value"))).select("value").first()
    if first is None:
        raise ValueError(EMPTY_EXPORT)
    header = first["value"]
    # Spark's reader takes a line of other blanks than ASCII's for the header.
    leading = at_start.where(F.trim("value") != "").select("value").first()
    if leading["value"] != header:
        return _without_headers(text)
    lines = _data_lines(spark, path, header)
    if lines.isEmpty():
        raise ValueError(EMPTY_EXPORT)
    return Export(header, lines.select("value", _row_order(F.lit(0))))


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line")]


def _row_order(file: Column) -> Column:
    return F.struct(file.alias("file"), "split", "line").alias("row_order")


def _data_lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """The lines that are not blank, without the first one of each file, and their places."""
    return (
        spark.read.schema(T.StructType([T.StructField(header, T.StringType())]))
        .option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
        .option("sep", _NO_SEPARATOR).option("quote", _NO_QUOTE).option("escape", _NO_QUOTE).option("lineSep", "\n")
        .csv(path)
        .toDF("value")
        .select("value", *_place())
        .where(~is_blank(F.col("value")))
    )


def _of_files(text: DataFrame, path: str) -> Export:
    """The export of several files, each with the layout of its own header.

    One aggregate over the first split of each file finds the headers. One row per
    file comes to the driver, as it does when Spark lists the files, and goes back
    to the lines as a small table.
    """
    starts = text.where(F.col("_metadata.file_block_start") == 0).select("value", *_place()).where(F.trim("value") != "")
    shown = F.when(~is_blank(F.col("value")), F.col("line"))
    found = starts.groupBy("file_path").agg(
        F.min_by("value", "line").alias("leading"), F.min_by("value", shown).alias("header")).collect()
    found = sorted((row for row in found), key=lambda row: row["file_path"])
    if any(row["header"] != row["leading"] for row in found):
        return _without_headers(text)
    if not found:
        raise ValueError(EMPTY_EXPORT)
    lines = _data_lines(text.sparkSession, path, found[0]["header"])
    return _numbered(lines, [(row["file_path"], row["header"]) for row in found])


def _numbered(lines: DataFrame, files: list[tuple[str, str]]) -> Export:
    """The lines with the number of their file and header; ``files`` are paths and headers in order.

    A line of a file that is not listed, because its first split has no header, ends the job.
    """
    spark = lines.sparkSession
    headers = list(dict.fromkeys(header for _, header in files))
    table = spark.createDataFrame(
        [(path, number, headers.index(header)) for number, (path, header) in enumerate(files)],
        "listed_path string, file int, header_no int")
    table = F.broadcast(table) if len(files) <= MAX_BROADCAST_FILES else table
    placed = lines.join(table, F.col("file_path") == F.col("listed_path"), "left")
    unknown = F.raise_error(F.concat(F.lit("no header in the first split of "), "file_path")).cast("int")
    placed = placed.select("value", _row_order(F.coalesce("file", unknown)), "header_no")
    if lines.isEmpty():
        raise ValueError(EMPTY_EXPORT)
    if len(headers) == 1:
        return Export(headers[0], placed.drop("header_no"))
    return Export(headers[0], placed, tuple(headers))


def _without_headers(text: DataFrame) -> Export:
    """The export from plain lines: of each file, the first line that is not blank is the header."""
    lines = text.select("value", *_place()).where(~is_blank(F.col("value")))
    headers = lines.groupBy(F.col("file_path").alias("header_path")).agg(
        F.min(F.struct("split", "line")).alias("at"), F.min_by("value", F.struct("split", "line")).alias("header"))
    files = sorted((row["header_path"], row["header"]) for row in headers.select("header_path", "header").collect())
    is_header = (F.col("file_path") == F.col("header_path")) & (F.struct("split", "line") == F.col("at"))
    headers = headers.select("header_path", "at")
    headers = F.broadcast(headers) if len(files) <= MAX_BROADCAST_FILES else headers
    return _numbered(lines.join(headers, is_header, "left_anti"), files)


def split_header(raw_lines: DataFrame, order: str) -> Export:
    """The same for any DataFrame of lines (value and an order column).

    The header is the first non-blank line, found with a top-1 per partition. No
    order value may be missing, nor the header's be repeated: no other line may
    be taken for it.
    """
    kept = raw_lines.where(~is_blank(F.col("value"))).select("value", F.col(order).alias("row_order"))
    first = kept.orderBy("row_order").first()
    if first is None:
        raise ValueError(EMPTY_EXPORT)
    unclear = kept.where(F.col("row_order").isNull() | (F.col("row_order") == F.lit(first["row_order"])))
    if unclear.limit(2).count() > 1 or first["row_order"] is None:
        raise ValueError(f"{order}: a value is missing, or the header's is repeated")
    lines = kept.where(F.col("row_order") > F.lit(first["row_order"]))
    if lines.isEmpty():
        raise ValueError(EMPTY_EXPORT)
    return Export(first["value"], lines)


def detect_delimiter(line: Column) -> Column:
    """Tab if it outnumbers both others, else ``;`` if it outnumbers commas, else ``,``."""
    def count(char: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(char), F.lit("")))

    tabs, commas, semicolons = count("\t"), count(","), count(";")
    return (
        F.when((tabs > commas) & (tabs > semicolons), "\t")
        .when(semicolons > commas, ";")
        .when(line.isNotNull(), ",")
    )


def header_names(line: Column) -> Column:
    """Header fields, trimmed and in lower case."""
    return F.transform(F.split(line, detect_delimiter(line)), lambda name: F.lower(trim(name)))


def field_position(names: Column, aliases: tuple[str, ...]) -> Column:
    """Position of the first alias that occurs, counted from 0; -1 if none does."""
    found = [F.nullif(F.array_position(names, alias), F.lit(0)) for alias in aliases]
    return (F.coalesce(*found, F.lit(0)) - 1).cast("int")


def field_positions(headers: DataFrame, header: str, *specs: InventorySpec) -> DataFrame:
    """Per header line: its delimiter and each field's position as ``<table>.<field>``."""
    line = F.col(header)
    kept = {name: F.col(name) for name in headers.columns}
    split = select_once(headers, {**kept, "delimiter": detect_delimiter(line), "names": header_names(line)})
    return split.select(*kept, "delimiter", *[
        field_position(F.col("names"), aliases).alias(f"{spec.table}.{field}")
        for spec in specs for field, aliases in spec.aliases.items()
    ])


def resolve_layouts(spark: SparkSession, headers: Sequence[str], spec: InventorySpec) -> list[Layout]:
    """Evaluate the header lines once; positions become literals in the plan."""
    lines = spark.range(0, 1, 1, 1).select(F.posexplode(F.array(*map(F.lit, headers))).alias("number", "header"))
    rows = field_positions(lines, "header", spec).orderBy("number").collect()
    layouts = []
    for row in rows:
        positions = {field: row[f"{spec.table}.{field}"] for field in spec.aliases}
        if positions[spec.required] < 0:
            names = ", ".join(spec.aliases[spec.required])
            raise ValueError(f"CSV must have a {spec.required} column ({names}): {row['header']}")
        layouts.append(Layout(row["delimiter"], positions))
    return layouts


def resolve_layout(spark: SparkSession, header: str, spec: InventorySpec) -> Layout:
    return resolve_layouts(spark, [header], spec)[0]
