"""Latency statistics with exact ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmatch.operators.ordering import PART, range_sorted

# The ranks reported, as fractions of the number of samples.
RANKS = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def duration_stats(samples: DataFrame, label: str, value: str) -> DataFrame:
    """Per label: count, min, max, avg, median, p95, p99 and total.

    A percentile is the sample at position floor(count * p) of the sorted
    samples. Equal samples are counted first; the distinct ones are sorted over
    all partitions, which splits a hot label, and only the partitions that hold
    a wanted position are looked at again.
    """
    counted = (
        samples.where(F.col(value).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = range_sorted(counted, ["label", "v"], unique=True).select("label", "v", "n", PART)

    # One row per label and partition: at most labels + partitions rows.
    parts = placed.groupBy("label", PART).agg(
        F.sum("n").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.sum(F.col("n") * F.col("v")).alias("total"),
    )
    label_parts = Window.partitionBy("label")
    earlier = label_parts.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.array(*[
        F.struct(F.lit(name).alias("rank"),
                 F.floor(F.col("count") * F.lit(share)).cast("bigint").alias("position"))
        for name, share in RANKS.items()
    ])
    targets = (
        parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("count", F.sum("n").over(label_parts))
        .select("label", PART, "before", "n", F.inline(wanted))
        .where((F.col("position") >= F.col("before")) & (F.col("position") < F.col("before") + F.col("n")))
        .select("label", PART, "rank", (F.col("position") - F.col("before")).alias("place"))
    )

    same_part = [F.col("s.label").eqNullSafe(F.col("t.label")), F.col(f"s.{PART}") == F.col(f"t.{PART}")]
    running = Window.partitionBy("label", PART).orderBy("v")
    candidates = (
        placed.alias("s").join(targets.alias("t"), same_part, "left_semi")
        .withColumn("upto", F.sum("n").over(running))
    )
    ranked = (
        candidates.alias("s").join(targets.alias("t"), same_part)
        .where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
        .groupBy("s.label")
        .agg(*[F.max(F.when(F.col("rank") == name, F.col("v"))).alias(name) for name in RANKS])
    )
    totals = parts.groupBy("label").agg(
        F.sum("n").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("total").alias("total"),
    )
    return totals.alias("a").join(ranked.alias("b"), F.col("a.label").eqNullSafe(F.col("b.label"))).select(
        "a.label", "count", "min", "max", (F.col("total") / F.col("count")).alias("avg"),
        *RANKS, "total",
    )
