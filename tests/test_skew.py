"""Hot groups, ties and partitionings, compared with brute force."""

import math
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.operators.batches import assign_batches, map_batches
from fleetmatch.operators.dedupe import duplicate_counts, first_wins
from fleetmatch.operators.nested import collect_groups
from fleetmatch.operators.ordering import range_sorted, with_row_index
from fleetmatch.operators.stats import duration_stats

ROWS = 3000


@pytest.fixture(scope="module")
def rows():
    """A third of the rows has one key, which is NULL; many values repeat."""
    chosen = random.Random(7)
    table = []
    for i in range(ROWS):
        key = None if i % 3 == 0 else chosen.choice(["a", "b", "c", f"k{i}"])
        value = 5.0 if i % 5 == 0 else round(chosen.gauss(0, 3), chosen.choice([0, 6]))
        table.append((i, key, value))
    chosen.shuffle(table)
    return table


def frame(spark, rows, partitions):
    return spark.createDataFrame(rows, "i bigint, key string, value double").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 13])
def test_first_wins_does_not_depend_on_partitions(spark, rows, partitions):
    expected = {}
    for i, key, value in sorted(rows, key=lambda row: row[0]):
        expected.setdefault(key, [i, value, 0])[2] += 1
    df = frame(spark, rows, partitions)
    got = first_wins(df, ["key"], "i", rows_per_key="n").collect()
    assert {r.key: [r.i, r.value, r.n] for r in got} == expected
    counts = duplicate_counts(df, ["key"]).first()
    assert tuple(counts) == (ROWS, len(expected), ROWS - len(expected))


def test_counts_of_an_empty_table(spark, rows):
    assert tuple(duplicate_counts(frame(spark, rows, 2).limit(0), ["key"]).first()) == (0, 0, 0)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_groups_are_whole_and_in_order(spark, rows, chunk):
    expected = defaultdict(list)
    for i, key, value in sorted(rows, key=lambda row: row[0]):
        expected[key].append((i, value))
    got = defaultdict(dict)
    for row in collect_groups(frame(spark, rows, 5), "key", ["i"], chunk_rows=chunk).collect():
        assert 0 < len(row["items"]) <= chunk
        got[row.key][row.chunk] = [tuple(item) for item in row["items"]]
    joined = {key: [item for n in sorted(parts) for item in parts[n]] for key, parts in got.items()}
    assert joined == dict(expected)
    for key, parts in got.items():
        assert sorted(parts) == list(range(math.ceil(len(expected[key]) / chunk)))


def brute_stats(values):
    ranked = sorted(values)
    n = len(ranked)
    return [n, ranked[0], ranked[-1], ranked[math.floor(n / 2)], ranked[math.floor(n * 0.95)],
            ranked[math.floor(n * 0.99)]]


@pytest.mark.parametrize("partitions", [1, 13])
def test_exact_ranks(spark, rows, partitions):
    groups = defaultdict(list)
    for _, key, value in rows:
        groups[key].append(value)
    groups["exact"] = [float(v) for v in range(20)]  # 0.95 * 20 is whole
    table = rows + [(ROWS + v, "exact", float(v)) for v in range(20)] + [(ROWS + 30, "empty", None)]
    got = duration_stats(frame(spark, table, partitions), "key", "value").collect()
    assert {r.label: [r["count"], r.min, r.max, r.median, r.p95, r.p99] for r in got} == {
        key: brute_stats(values) for key, values in groups.items()}
    for row in got:
        assert row.total == pytest.approx(sum(groups[row.label]), rel=1e-9, abs=1e-9)
        assert row.avg == pytest.approx(sum(groups[row.label]) / len(groups[row.label]), rel=1e-9, abs=1e-9)


def test_a_hot_label_is_spread_over_partitions(spark):
    df = spark.range(20000).select(F.lit("hot").alias("label"), F.col("id").cast("double").alias("value"))
    enabled = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in range_sorted(df, ["label", "value"]).groupBy("order_part").count().collect()]
        row = duration_stats(df, "label", "value").first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", enabled)
    assert len(sizes) == 8 and max(sizes) < 20000 / 4
    assert (row.median, row.p95, row.p99) == (10000.0, 19000.0, 19800.0)


def test_equal_order_keys_are_spread_and_numbered(spark):
    df = spark.range(9000).select(F.col("id").alias("i"), F.lit("same").alias("day"),
                                  F.create_map(F.lit("k"), F.col("id")).alias("m"))
    enabled = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in range_sorted(df, ["day"]).groupBy("order_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", enabled)
    assert len(sizes) == 8 and max(sizes) < 9000 / 4
    indexed = with_row_index(df, ["day"])
    assert sorted(r.row_index for r in indexed.select("row_index").collect()) == list(range(9000))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_row_index_is_the_position(spark, rows, coalesce):
    enabled = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        indexed = with_row_index(frame(spark, rows, 7), ["value", "i"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", enabled)
    expected = {row[0]: n for n, row in enumerate(sorted(rows, key=lambda row: (row[2], row[0])))}
    assert {r.i: r.row_index for r in indexed} == expected


@pytest.mark.parametrize("size,count", [(100, 1050), (1, 5), (7, 7), (100, 0)])
def test_batches(spark, size, count):
    df = spark.range(count).withColumnRenamed("id", "i")
    got = {r.i: r.batch_id for r in assign_batches(df, ["i"], size).collect()}
    assert got == {i: i // size for i in range(count)}


def test_function_sees_whole_batches_once(spark):
    def describe(batch):
        return pd.DataFrame({"first": [batch["i"].iloc[0]], "n": [len(batch)], "ordered": [batch["i"].is_monotonic_increasing]})

    schema = T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("ordered", T.BooleanType())])
    df = spark.range(2570).select((F.lit(2569) - F.col("id")).alias("i"))
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # smaller than a batch
        got = map_batches(df, describe, schema, ["i"], size=100).orderBy("batch_id").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert [(r.batch_id, r.first, r.n) for r in got] == [(b, b * 100, min(100, 2570 - b * 100)) for b in range(26)]
    assert all(r.ordered for r in got)


def test_function_may_change_the_number_of_rows(spark):
    def doubled(batch):
        return pd.concat([batch, batch])

    schema = T.StructType([T.StructField("i", T.LongType())])
    got = map_batches(spark.range(25).withColumnRenamed("id", "i"), doubled, schema, ["i"], size=10)
    assert sorted(r.i for r in got.collect()) == sorted(list(range(25)) * 2)


def test_equal_rows_are_spread_too(spark):
    rows = spark.range(90000).selectExpr("IF(id % 3 = 0, id, -1L) AS k", "'same' AS v")
    enabled = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = [r["count"] for r in range_sorted(rows, ["k"]).groupBy("order_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", enabled)
    assert len(sizes) == 8 and sum(sizes) == 90000 and max(sizes) < 3 * 90000 / len(sizes)
    indexed = with_row_index(rows, ["k"])
    assert indexed.agg({"row_index": "max"}).first()[0] == 89999 and indexed.select("row_index").distinct().count() == 90000
