"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the catalogue
from catalog.registry import QUERIES
from palimpsest.operators.history import interval_join
from palimpsest.plans import layout as Y
from palimpsest.plans.changes import booking_state
from palimpsest.plans.dashboard import lead_time_distribution
from palimpsest.plans.marts import booking_facts
from palimpsest.plans.reconcile import redundancy
from palimpsest.session import work_dir
from palimpsest.sources import raw as I
from palimpsest.sources.inventory import partition_inventory

# These write and read back when built; their parts are covered by the others.
WRITERS = {
    "check_report", "extract_complete", "ingest_window", "partition_overwrite", "replay_twice",
    "empty_window_clear", "schema_union", "schema_evolution", "bootstrap", "events_scan",
    "metrics_load", "cdc_stream_state", "cdc_stream_counts", "cdc_stream_upserts", "cdc_stream_dedup",
    "cdc_lag", "cdc_table_counts",
} | {n for n in QUERIES if n.startswith("layout_")}


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_cross_join_and_no_python(name, spark, sf):
    plan = plan_of(QUERIES[name](spark, sf))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert banned not in plan, plan


def test_latest_version_is_limited_before_the_exchange(frames):
    plan = plan_of(frames.stg_bookings)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_window_bounds_reach_the_scan(spark, frames):
    path = work_dir(spark, "push")
    frames.stg_bookings.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(I.scan_window(stored, "1998-01-01", "1998-02-01").select("booking_id"))
    assert "GreaterThanOrEqual(updated_at" in plan and "LessThan(updated_at" in plan
    assert "ReadSchema: struct<booking_id:bigint,updated_at:timestamp>" in plan


def test_only_needed_columns_are_read(spark, frames):
    plan = plan_of(lead_time_distribution(booking_facts(frames.stg_bookings)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_inventory_of_a_stored_table_reads_footers_only(spark, frames):
    root = work_dir(spark, "inventory")
    frames.raw_bookings.where("_interval_start < '1996-01-01'").write.partitionBy("_interval_start").parquet(root)
    plan = plan_of(partition_inventory(spark.read.parquet(root), "bookings"))
    assert "ReadSchema: struct<>" in plan


def test_distinct_keys_are_counted_without_expanding(frames):
    plan = plan_of(redundancy(frames.raw_bookings, "bookings", "booking_id"))
    assert "Expand" not in plan and "bitmap_construct_agg" in plan.lower()


def test_only_the_newest_image_of_a_key_is_parsed(frames):
    tree = booking_state(frames.event_log)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    parsed = [i for i, line in enumerate(tree) if "from_json" in line]
    assert parsed and max(parsed) < min(i for i, line in enumerate(tree) if "Window" in line)


def test_date_window_opens_only_its_folders(spark, frames):
    facts = frames.base_facts
    root = work_dir(spark, "layout")
    paths = Y.write_layouts(facts, root, ["partitioned"], unit="month")
    copy = Y.read_layout(spark, paths["partitioned"], facts)
    plan = plan_of(Y.amount_by_hotel_since(copy, "2001-07-15"))
    assert "PartitionFilters: [isnotnull(booking_period" in plan
    assert Y.amount_by_hotel_since(copy, "2001-07-15").exceptAll(
        Y.amount_by_hotel_since(facts, "2001-07-15")).isEmpty()


def test_hot_customer_is_split_in_the_interval_join(spark):
    """Half of the facts belong to one customer: the adaptive join splits them."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 400_000, 1, 8).select(
            "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000).alias("customer_id"),
            F.timestamp_seconds(F.col("id")).alias("created_at"))
        bounds = spark.range(5000).select(
            F.col("id").alias("customer_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("v")
        ).select(
            "customer_id", "v",
            F.when(F.col("v") == 1, F.timestamp_seconds(F.lit(1000))).alias("valid_from"),
            F.when(F.col("v") == 0, F.timestamp_seconds(F.lit(1000))).alias("valid_to"))
        joined = interval_join(facts, bounds, "customer_id", "created_at", ["v"])
        assert joined.count() == 400_000
        rows = joined.groupBy("v").count()
        assert {r.v: r["count"] for r in rows.collect()} == {0: 1000, 1: 399_000}
        assert "SortMergeJoin(skew=true)" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
