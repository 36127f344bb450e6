"""JSON-lines log as a dataset: write, read, and the most recent entries."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmatch.functions import is_blank
from fleetmatch.operators.projection import quoted

COUNTS = "_counts"  # beside the appends; readers of the log pass over such a name
BASE_FIELDS = ("timestamp", "level", "message")


def log_line(timestamp: Column, level: Column, message: Column,
             extra: Mapping[str, Column] | None = None) -> Column:
    """One JSON object; an extra field replaces a base field of the same name in place."""
    fields = dict(zip(BASE_FIELDS, (timestamp, level, message)))
    fields.update(extra or {})
    entry = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(entry, {"ignoreNullFields": "false"})


def append_log(lines: DataFrame, path: str, append_id: str, *order: str, line: str | None = None) -> None:
    """Write one append; a repeated ``append_id`` replaces what it wrote before.

    The JSON objects are in the column ``line``, by default the only column that
    is not in ``order``. Appends sort by their ids, so use the run's time. With
    ``order`` the lines are range-sorted into the part files, and the log reads
    back in that order; without it the lines stay as they are partitioned.
    """
    names = [name for name in lines.columns if name not in order]
    if line is None and len(names) != 1:
        raise ValueError(f"which of {names} is the line?")
    if order:
        lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    spark, folder = lines.sparkSession, os.path.join(path, f"append_id={append_id}")
    lines.select(quoted(line or names[0])).write.mode("overwrite").text(folder)
    written = spark.read.option("lineSep", "\n").text(folder).where(~is_blank(F.col("value"))).agg(
        F.lit(str(append_id)).alias("id"), F.count(F.lit(1)).alias("n"))
    written.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, COUNTS, f"append_id={append_id}"))


def _append_ids(spark: SparkSession, path: str) -> list[str]:
    """The ids of all appends, the newest first; one name per append comes to the driver."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder) if status.isDirectory()]
    return sorted((name.partition("=")[2] for name in names if name.startswith("append_id=")), reverse=True)


def read_recent(spark: SparkSession, path: str, lines: int = 50) -> DataFrame:
    """The last ``lines`` entries of a stored log, oldest first, from its newest appends alone.

    The number of lines of each append, kept beside the log, tells how many appends
    to open; one without lines or without a number is opened too and adds none.
    """
    newest = _append_ids(spark, path)
    counts = {}
    if newest:
        try:
            counted = spark.read.schema("id string, n bigint").parquet(os.path.join(path, COUNTS))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            # An append with lines brings at least one, so no more than these are needed.
            top = counted.where("n > 0").orderBy(F.desc("id")).limit(lines)
            counts = {row["id"]: row["n"] for row in top.collect()}
    opened, found = [], 0
    for append_id in newest:
        if found >= lines:
            break
        opened.append(append_id)
        found += counts.get(append_id, 0)
    return recent(read_log(spark, path, opened), "line_order", lines=lines)


def read_log(spark: SparkSession, path: str, append_ids: Sequence[str] | None = None) -> DataFrame:
    """timestamp, level, message, extra map, and line_order for ``recent``; of the appends given, or of all.

    A line's place is its append, the number of its part file, the split and the
    line in it; when the files were finished does not matter.
    """
    fields = F.from_json("value", "map<string,string>")
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).try_cast("int")
    return (
        spark.read.option("lineSep", "\n").option("basePath", path)
        .schema("value string, append_id string").text(
            path if append_ids is None else [os.path.join(path, f"append_id={i}") for i in append_ids])
        .where(~is_blank(F.col("value")))
        .select(
            *[fields[name].alias(name) for name in BASE_FIELDS],
            F.map_filter(fields, lambda name, _: ~name.isin(*BASE_FIELDS)).alias("extra"),
            "value",
            F.struct(
                F.col("append_id"),
                part.alias("part"),
                F.col("_metadata.file_name").alias("file"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("line_order"),
        )
    )


def recent(log: DataFrame, *order: str, lines: int = 50) -> DataFrame:
    """The last ``lines`` entries, oldest first.

    Each partition keeps its own top rows and only those are merged, so the log
    is never sorted as a whole.
    """
    newest = log.orderBy(*[F.col(name).desc() for name in order]).limit(lines)
    return newest.orderBy(*order)
