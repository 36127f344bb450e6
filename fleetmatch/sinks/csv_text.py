"""CSV text in the export form.

Every value is quoted and NULL is written as nothing. Spark's own CSV writer
writes NULL and the empty string alike, so the lines are built as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(value: Column) -> Column:
    text = F.replace(value.cast("string"), F.lit('"'), F.lit('""'))
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit(""))


def csv_line(values: Sequence[Column]) -> Column:
    return F.concat_ws(",", *[quoted(value) for value in values])


def _sections(rows: DataFrame, headings: Mapping[str, str],
              order: Sequence[tuple[str, str]]) -> tuple[DataFrame, list[Column]]:
    header = rows.sparkSession.range(1).select(
        F.lit(0).alias("section"),
        F.lit(",".join(f'"{heading}"' for heading in headings.values())).alias("line"),
    )
    data = rows.select(
        F.lit(1).alias("section"),
        csv_line([F.col(name) for name in headings]).alias("line"),
        *[F.col(name).alias(f"by_{name}") for name, _ in order],
    )
    keys = [F.desc(f"by_{name}") if way == "desc" else F.asc(f"by_{name}") for name, way in order]
    return header.unionByName(data, allowMissingColumns=True), [F.asc("section"), *keys]


def csv_lines(rows: DataFrame, headings: Mapping[str, str],
              order: Sequence[tuple[str, str]]) -> DataFrame:
    """Header and data in one column ``line``, sorted by ``order`` (name, asc or desc).

    ``headings`` maps column names to headings. The header is sorted in front of
    the data, which puts it at the start of the first part file: the sort stays
    a range exchange and no single task handles the whole report.
    """
    lines, keys = _sections(rows, headings, order)
    return lines.orderBy(*keys).select("line")


def write_csv_text(rows: DataFrame, headings: Mapping[str, str], order: Sequence[tuple[str, str]],
                   path: str, one_file: bool = False) -> None:
    """Write part files whose concatenation in name order is the CSV text; nothing for no rows.

    ``one_file`` is for results of a known handful of rows only.
    """
    if rows.isEmpty():
        lines = rows.select(F.lit("").alias("line")).limit(0)
    elif one_file:
        sections, keys = _sections(rows, headings, order)
        lines = sections.coalesce(1).sortWithinPartitions(*keys).select("line")
    else:
        lines = csv_lines(rows, headings, order)
    lines.write.mode("overwrite").text(path)
