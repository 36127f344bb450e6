"""First-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.operators.projection import quoted


def first_wins(df: DataFrame, keys: Sequence[str], order: str,
               rows_per_key: str | None = None, keep_order: bool = True) -> DataFrame:
    """Keep, per key, the row that comes first in ``order``; NULL is a key too, and the last place.

    ``min_by`` is combined on the map side, so each task sends at most one row
    per key and a hot key costs one row per task. ``rows_per_key`` names an
    extra column with the number of rows that had the key.
    """
    # Inside a struct a NULL order is a value, which min_by does not skip; it comes last.
    place = F.struct(F.col(quoted(order)).isNull(), F.col(quoted(order)))
    payload = [name for name in df.columns if name not in keys and (keep_order or name != order)]
    fields = [F.col(quoted(name)).alias(f"value{i}") for i, name in enumerate(payload)]
    kept = [F.min_by(F.struct(*fields), place).alias("first_wins_kept")] if payload else []
    grouped = df.groupBy(*map(quoted, keys)).agg(*kept, F.count(F.lit(1)).alias("first_wins_rows"))
    columns = [*map(quoted, keys), *[F.col(f"first_wins_kept.value{i}").alias(name) for i, name in enumerate(payload)]]
    return grouped.select(*columns, *([F.col("first_wins_rows").alias(rows_per_key)] if rows_per_key else []))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows read, distinct keys, duplicates skipped."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
