"""JSON records as VARIANT; a key that a record repeats has its last value."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.operators.projection import quoted, select_once

_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


@contextmanager
def _last_key_wins(spark: SparkSession) -> Iterator[None]:
    """Spark takes the setting into a parsing expression when a plan is made with it."""
    before = spark.conf.get(_REPEATED_KEYS, None)
    spark.conf.set(_REPEATED_KEYS, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REPEATED_KEYS)
        else:
            spark.conf.set(_REPEATED_KEYS, before)


def record_text(df: DataFrame, column: str) -> Column:
    """The records of a column as JSON text, in the order of their keys if the column keeps it."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.col(quoted(column))
    # Keys with NULL values are keys.
    return F.to_json(F.col(quoted(column)), {"ignoreNullFields": "false"})


def with_record(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the column's JSON records as the VARIANT ``name``; NULL where the text is not JSON."""
    kept = {field: F.col(quoted(field)) for field in df.columns}
    if isinstance(df.schema[column].dataType, T.VariantType):
        return select_once(df, {**kept, name: F.col(quoted(column))})
    with _last_key_wins(df.sparkSession):
        return select_once(df, {**kept, name: F.try_parse_json(record_text(df, column))})
