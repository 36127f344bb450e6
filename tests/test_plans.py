"""The physical plans keep the properties the jobs rely on at scale."""

import re

from pyspark.sql import functions as F

from fleetmatch.operators.batches import assign_batches
from fleetmatch.operators.inventory import keyed_rows
from fleetmatch.operators.stats import duration_stats
from fleetmatch.plans import fixtures as fx
from fleetmatch.plans.queries import QUERIES
from tests.conftest import plan_of


def exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_coverage_match_shuffles_each_side_once(spark, sf_dir):
    plan = plan_of(QUERIES["coverage_match"](spark, sf_dir))
    assert "SortMergeJoin [hostname" in plan and "FullOuter" in plan
    assert exchanges(plan) == ["hashpartitioning", "hashpartitioning"]
    # Final aggregates leave each side sorted: two sorts per side, none for the join itself.
    assert plan.count("Sort [hostname") == 4


def test_first_wins_aggregates_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["parse_inventory"](spark, sf_dir))
    assert "partial_min_by" in plan
    assert exchanges(plan) == ["hashpartitioning"]


def test_no_python_outside_batch_map(spark, sf_dir):
    for name, query in QUERIES.items():
        if name in ("batch_map", "import_both_report", "snapshot_sync", "etl_event_log_stored",
                    "export_report_files"):
            continue
        plan = plan_of(query(spark, sf_dir))
        assert "Python" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["dedupe_first_wins"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"}


def test_hostname_is_normalised_once(spark, sf_dir):
    rows = fx.derived(spark, sf_dir, "lineitem", {"hostname": fx.RAW_A["host_raw"], "row_order": "l_orderkey"})
    plan = plan_of(keyed_rows(rows))
    below = plan[plan.rindex("Generate"):]
    assert plan.count("LOCAL") == 1
    assert "CORP" not in below[below.index("\n"):]


def test_no_single_partition_for_ranked_operators(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    for df in (duration_stats(events, "event_type", "value"), assign_batches(events, ["event_id"]),
               QUERIES["dedupe_first_wins"](spark, sf_dir), QUERIES["group_collect"](spark, sf_dir)):
        assert "SinglePartition" not in plan_of(df)


def test_recent_logs_keep_a_top_n_per_partition(spark, sf_dir):
    plan = plan_of(QUERIES["recent_logs"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_event_counts_scan_each_export_once(spark, sf_dir):
    plan = plan_of(QUERIES["etl_event_log"](spark, sf_dir))
    scans = re.findall(r"FileScan parquet.*?Location: \S+ \S*?(\w+)\.parquet", plan)
    assert sorted(scans) == ["customer", "events", "lineitem", "orders"]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_audits_read_staged_inventories(spark, sf_dir):
    plan = plan_of(QUERIES["constraint_audit"](spark, sf_dir))
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_groups_are_not_joined_by_key_alone(spark, sf_dir):
    plan = plan_of(QUERIES["group_collect_large"](spark, sf_dir))
    rows = [line for line in plan.split("\n") if "Join" in line and "order_part" in line]
    assert any("group_part" in line for line in rows)
    assert not re.search(r"Exchange hashpartitioning\(coalesce\(kind[^,]*, \), isnull\(kind[^,]*\), \d+\)", plan)


def test_rows_of_one_row_group_are_dealt_to_several_tasks(spark, tmp_path):
    rows = spark.range(400_000).select(F.xxhash64("id").alias("o_orderkey"), F.xxhash64("id", F.lit(1)).alias("o_custkey"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = fx.dealt(spark, str(tmp_path), "orders")
    assert found.rdd.getNumPartitions() > 1
    assert found.exceptAll(rows).isEmpty() and found.count() == 400_000
