"""A projection whose expressions are evaluated once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def select_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Like ``select``, for costly expressions that are filtered on afterwards.

    The optimizer copies a filter below a plain projection together with the
    expressions it needs, so those would run twice or more. It does not do that
    below a generator, here one that yields exactly one row.
    """
    record = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(F.inline(F.array(record)))
