"""Positions in a total order, without sorting in one task.

The rows are range-partitioned and sorted, so a partition knows the position of
its rows; adding the sizes of the partitions before it gives the position in the
whole table. A hot key only makes more partitions carry that key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.operators.projection import quoted
from fleetmatch.session import scratch_path

PART = "order_part"
PLACE = "order_place"
_TIE = "order_tie"

_PLACE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _tie_breaker(df: DataFrame) -> Column:
    """A hash of the row; range partitioning cannot split rows with equal keys.

    The row's number in its partition is hashed with it, so that equal rows, which
    are interchangeable, have different ties too.
    """
    hashable = [field.name for field in df.schema.fields
                if not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))]
    return F.xxhash64(*map(quoted, hashable), F.monotonically_increasing_id())


def range_sorted(df: DataFrame, order: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows sorted over all partitions, with partition number and place in it.

    Rows that are equal in ``order`` are put in the order of a hash, which spreads
    them over partitions; ``unique`` says that there are none. The
    result is a table written to the shared folder, because several
    branches read it and must see the same partition bounds, also after an
    executor is lost; each branch reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, "sorted")
    number = F.monotonically_increasing_id()
    keys = list(order)
    if not unique:
        df = df.withColumn(_TIE, _tie_breaker(df))
        keys.append(_TIE)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(_TIE)
        .withColumn(PART, F.shiftright(number, _PLACE_BITS).cast("int"))
        .withColumn(PLACE, number.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
    )
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def part_offsets(placed: DataFrame) -> DataFrame:
    """For each sorted partition the number of rows before it, as ``offset``.

    One row per partition comes to the driver, whatever the size of the table.
    """
    sizes = placed.groupBy(PART).count().orderBy(PART).collect()
    offsets, before = [], 0
    for part, size in sizes:
        offsets.append((part, before))
        before += size
    schema = T.StructType([T.StructField(PART, T.IntegerType()), T.StructField("offset", T.LongType())])
    return placed.sparkSession.createDataFrame(offsets, schema)


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index",
                   unique: bool = False) -> DataFrame:
    """Add the 0-based position of each row in the order given."""
    placed = range_sorted(df, order, unique)
    return (
        placed.join(F.broadcast(part_offsets(placed)), PART)
        .withColumn(name, F.col("offset") + F.col(PLACE))
        .drop(PART, PLACE, "offset")
    )
