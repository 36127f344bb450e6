"""Consecutive batches of rows, and a user function per batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.operators.ordering import with_row_index
from fleetmatch.operators.projection import quoted
from fleetmatch.session import scratch_path

BATCH_SIZE = 100  # Fixed value: rows per batch unless stated.


def assign_batches(df: DataFrame, order: Sequence[str], size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_id``: rows 0 to size-1 in the order are batch 0, and so on."""
    return with_row_index(df, order).withColumn(
        "batch_id", F.floor(F.col("row_index") / size).cast("bigint"))


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType,
                order: Sequence[str], size: int = BATCH_SIZE) -> DataFrame:
    """Call ``function`` once per batch; its rows get the batch's ``batch_id``.

    Batches are mapped where the sort left them; only the rows of batches that lie
    across the border of two tasks move, at most two batches per task. Results are
    written to the shared folder, so the function is not called again for them.
    Sort by batch_id to restore the order of the input.
    """
    spark, columns, fields = df.sparkSession, df.columns, schema.fieldNames()
    rows = assign_batches(df, order, size).select("batch_id", "row_index", *map(quoted, columns))
    total = rows.count()
    # Numbered names, as a result may have the names of the input.
    shown = [f"result_{i}" for i in range(len(fields))]
    kept = [f"kept_{i}" for i in range(len(columns))]
    rows = rows.toDF("batch_id", "row_index", *kept)
    output = T.StructType([
        T.StructField("batch_id", T.LongType()), T.StructField("row_index", T.LongType()),
        *[T.StructField(name, field.dataType) for name, field in zip(shown, schema.fields)],
        *[T.StructField(name, rows.schema[name].dataType) for name in kept]])

    def missing(frame: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
        for name in names:
            frame[name] = pd.Series([None] * len(frame), index=frame.index, dtype=object)
        return frame[[field.name for field in output.fields]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def handed_on(batches: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole, parts = [], []
            for batch in batches:
                number = batch["batch_id"].iloc[0]
                if len(batch) < min(size, total - number * size):
                    parts.append(batch)
                    continue
                given = batch[kept].reset_index(drop=True)
                given.columns = columns
                result = function(given)[fields]
                result.columns = shown
                whole.append(result.assign(batch_id=number))
            if whole:
                done = pd.concat(whole, ignore_index=True)
                done["row_index"] = -1
                yield missing(done, kept)
            if parts:
                yield missing(pd.concat(parts, ignore_index=True), shown)

        rest = None  # the last batch of a frame may continue in the next one
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            ids = frame["batch_id"].to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1)]
            yield from handed_on([frame.iloc[start:end] for start, end in zip(cuts, cuts[1:])])
            rest = frame.iloc[cuts[-1]:]
        if rest is not None and len(rest):
            yield from handed_on([rest])

    path = scratch_path(spark, "batches")
    rows.mapInPandas(run, output).write.parquet(path)
    mapped = spark.read.schema(output).parquet(path)
    border = mapped.where("row_index >= 0").select("batch_id", "row_index", *kept)
    # A fixed number of partitions: merged ones would leave Python workers idle.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    border = border.repartition(partitions, "batch_id").sortWithinPartitions("batch_id", "row_index")
    results = mapped.where("row_index < 0").unionByName(border.mapInPandas(run, output))
    return results.select(*[F.col(name).alias(field) for name, field in zip(shown, fields)], "batch_id")
