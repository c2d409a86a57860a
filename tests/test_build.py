"""Checks counted while models are written, against the same checks on stored models."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from catalog.frames import CALENDAR, Frames
from palimpsest.plans import checks as K
from palimpsest.plans.build import BucketedWarehouse, Warehouse, build_and_check, build_models
from palimpsest.plans.marts import booking_facts, rpt_bookings_dashboard, with_payments, with_tiers
from palimpsest.plans.staging import payments_by_booking
from palimpsest.session import work_dir


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def raw_of(t, disturb=lambda name, df: df):
    return {n: disturb(n, getattr(t, f"raw_{n}")) for n in ("hotels", "customers", "bookings", "payments")}


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_counted_checks_equal_the_checks_of_stored_models(spark, sf):
    t = Frames(spark, sf)

    def disturb(name, df):  # something for most of the checks to find
        if name == "bookings":
            return df.withColumn("status", F.when(F.col("booking_id") % 7 == 0, "odd").otherwise(F.col("status")))
        if name == "hotels":
            return df.where("hotel_id <> 3")
        if name == "payments":
            return df.withColumn("amount", F.when(F.col("payment_id") % 11 == 0, -F.col("amount")).otherwise(F.col("amount")))
        return df.withColumn("loyalty_tier", F.when(F.col("customer_id") % 5 == 0, None).otherwise(F.col("loyalty_tier")))

    raw = raw_of(t, disturb)
    plain = build_models(Warehouse(spark, work_dir(spark, "plain")), raw, t.booking_log, CALENDAR)
    wanted = rows(K.check_report(plain, 100))
    _, report = build_and_check(Warehouse(spark, work_dir(spark, "counted")), raw, t.booking_log, CALENDAR, 100)
    assert rows(report) == wanted
    assert len([r for r in wanted if r[3] != "pass"]) > 8


def test_the_report_of_empty_tables(spark, sf):
    t = Frames(spark, sf)
    raw = raw_of(t, lambda _, df: df.limit(0))
    plain = build_models(Warehouse(spark, work_dir(spark, "plain")), raw, t.booking_log.limit(0), CALENDAR)
    _, report = build_and_check(
        Warehouse(spark, work_dir(spark, "counted")), raw, t.booking_log.limit(0), CALENDAR, 100)
    assert rows(report) == rows(K.check_report(plain, 100))


def test_the_report_reads_few_models_again(spark, sf):
    """Models are read once for their keys; then only the versions and the daily volume."""
    t = Frames(spark, sf)
    house = Warehouse(spark, work_dir(spark, "scans"))
    _, report = build_and_check(house, raw_of(t), t.booking_log, CALENDAR, 100)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    files = [f for df in [report] for f in df.inputFiles()]
    scanned = {re.sub(r"^.*/scans-[^/]*/([^/]*)/.*$", r"\1", f) for f in files}
    assert scanned == {"key_counts", "dim_customers", "fct_bookings"}
    assert plan.count("Relation [") <= 12


def test_bucketed_models_join_without_exchange(spark, sf):
    """The report view over stored models: no exchange for its customer keys, nor for the payments of
    the bookings; equal rows."""
    t = Frames(spark, sf)
    house = BucketedWarehouse(spark, work_dir(spark, "buckets"), f"b_{uuid.uuid4().hex[:8]}", 4)
    tables = build_models(house, raw_of(t), t.booking_log, CALENDAR)
    plain = build_models(Warehouse(spark, work_dir(spark, "plain")), raw_of(t), t.booking_log, CALENDAR)
    setting, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(setting, "-1")
    try:
        facts, dim = tables["fct_bookings"], tables["dim_customers"]
        plan = plan_of(with_tiers(facts, dim))
        assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan, plan
        paid = with_payments(booking_facts(tables["int_bookings_actives"]), payments_by_booking(tables["stg_payments"]))
        plan = plan_of(paid)
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        view = rpt_bookings_dashboard(facts, dim, tables["dim_hotels"], tables["dim_dates"])
        assert view.exceptAll(plain["rpt_bookings_dashboard"]).isEmpty()
        assert view.count() == plain["rpt_bookings_dashboard"].count() > 0
    finally:
        spark.conf.set(setting, before)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {house.name}_{name}")
