"""Neighbours, intervals and as-of joins against brute force, hot keys included."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators.compare import fingerprint, id_difference
from palimpsest.operators.history import (
    asof_join, customer_history, hot_key_cuts, interval_join, with_neighbours, with_slots)
from palimpsest.operators.latest import flag_repeats, latest_by

START = dt.datetime(2020, 1, 1)


def instants(rng, n):
    return [START + dt.timedelta(minutes=m) for m in rng.sample(range(0, 60 * 24 * 700), n)]


@pytest.fixture(scope="module", params=[1, 2])
def world(request, spark):
    """Version lists and facts; key 0 holds most of the rows of both."""
    rng = random.Random(request.param)
    versions = [(k, at, rng.choice("abc")) for k, n in [(0, 300), (1, 1), (2, 5), (3, 40)]
                for at in instants(rng, n)]
    facts = [(i, rng.choice([0] * 7 + [1, 2, 3, 4]), at)
             for i, at in enumerate(instants(rng, 900))]
    facts += [(10_000 + i, k, at) for i, (k, at, _) in enumerate(versions)]  # exact bounds
    v = spark.createDataFrame(versions, "customer_id int, updated_at timestamp, tier string")
    f = spark.createDataFrame(facts, "booking_id int, customer_id int, created_at timestamp")
    return versions, facts, v, f


@pytest.mark.parametrize("rows_per_slot", [1, 7, 100, 10**6])
def test_neighbours(world, rows_per_slot):
    versions, _, v, _ = world
    rows = with_neighbours(
        v, ["customer_id"], "updated_at", ["updated_at", "tier"], rows_per_slot).collect()
    assert len(rows) == len(versions)
    for k in {k for k, _, _ in versions}:
        ordered = sorted((at, tier) for c, at, tier in versions if c == k)
        got = {r.updated_at: r for r in rows if r.customer_id == k}
        for i, (at, _) in enumerate(ordered):
            before, after = got[at]._previous, got[at]._next
            assert (tuple(before) if before else None) == (ordered[i - 1] if i else None)
            assert (tuple(after) if after else None) == (
                ordered[i + 1] if i + 1 < len(ordered) else None)


def expected_versions(versions, facts):
    out = {}
    for i, k, at in facts:
        mine = sorted((u, t) for c, u, t in versions if c == k)
        past = [m for m in mine if m[0] <= at]
        out[i] = past[-1][1] if past else mine[0][1] if mine else None
    return out


def dimension(v):
    renamed = v.withColumnRenamed("tier", "loyalty_tier").withColumns({
        "first_name": F.lit("x"), "last_name": F.lit("y"), "email": F.lit("z"),
        "created_at": F.lit(START)})
    return customer_history(renamed)


@pytest.mark.parametrize("plan", ["interval", "asof-1", "asof-20", "asof-300", "asof-1000000"])
def test_point_in_time(world, plan):
    versions, facts, v, f = world
    dim = dimension(v)
    if plan == "interval":
        joined = interval_join(f, dim, "customer_id", "created_at", ["loyalty_tier"])
    else:
        joined = asof_join(f, dim, "customer_id", "created_at", "observed_from",
                           ["loyalty_tier"], rows_per_slot=int(plan.split("-")[1]))
    rows = joined.collect()
    assert len(rows) == len(facts)
    assert {r.booking_id: r.loyalty_tier for r in rows} == expected_versions(versions, facts)


def test_a_hot_customer_of_one_month_spans_many_slots(spark):
    """Nine facts in ten are of one customer and one month; the slots are cut inside it."""
    at = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id"))
    facts = spark.range(20_000).select(
        F.col("id").alias("booking_id"), F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("customer_id"),
        at.alias("created_at"))
    cuts = hot_key_cuts(facts, ["customer_id"], "created_at", 1_000)
    slots = with_slots(facts, cuts, ["customer_id"], "created_at").where("customer_id = 7").groupBy(
        "_slot").count().collect()
    assert len(slots) == 18 and max(r["count"] for r in slots) <= 2_000
    versions = spark.range(0, 20_000, 37).select(
        F.lit(7).cast("long").alias("customer_id"), at.alias("observed_from"), F.col("id").alias("tier"))
    bounds = versions.withColumns({
        "valid_from": F.when(F.col("tier") > 0, F.col("observed_from")),
        "valid_to": F.when(F.col("tier") + 37 < 20_000, F.timestamp_seconds(
            F.lit(1_600_000_000) + F.col("tier") + 37))})
    for size in (1_000, 10**6):
        found = asof_join(facts, versions, "customer_id", "created_at", "observed_from", ["tier"], size)
        wanted = interval_join(facts, bounds, "customer_id", "created_at", ["tier"])
        assert found.count() == 20_000 and found.exceptAll(wanted).isEmpty()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "<=" not in plan.split("Join")[1].split("\n")[0]  # no residual: nothing is compared pairwise


def test_facts_at_one_instant_and_without_time(spark):
    facts = spark.createDataFrame(
        [(i, 1, START) for i in range(50)] + [(100, 1, None), (101, None, START), (102, 2, START)],
        "booking_id int, customer_id int, created_at timestamp")
    versions = spark.createDataFrame(
        [(1, START, "a"), (1, START + dt.timedelta(days=1), "b")], "customer_id int, since timestamp, tier string")
    for size in (1, 100):
        rows = asof_join(facts, versions, "customer_id", "created_at", "since", ["tier"], size).collect()
        assert {r.booking_id: r.tier for r in rows} == {
            **dict.fromkeys(range(50), "a"), 100: None, 101: None, 102: None}


def test_latest_of_a_hot_key(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id")
    got = {r.k: r.id for r in latest_by(rows, ["k"], F.desc("id")).collect()}
    want: dict[int, int] = {}
    for i in range(20_000):
        want[-1 if i % 3 == 0 else i % 50] = i
    assert got == want


def test_repeats_of_a_hot_group(spark):
    """A third of all rows are copies of one submission."""
    rows = spark.range(9_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("booking"),
        F.when(F.col("id") % 10 != 1, F.lit(START)).alias("paid_at"),
        (F.lit(9_000) - F.col("id")).alias("created"))
    flagged = flag_repeats(rows, "row_id", ["booking", "paid_at"], "paid_at",
                           ["created", "row_id"], "repeat")
    got = {r.row_id for r in flagged.where("repeat").collect()}
    hot = [i for i in range(9_000) if i % 3 == 0 and i % 10 != 1]
    assert got == set(hot) - {max(hot)}
    assert flagged.count() == 9_000


def test_id_difference_ignores_repeats(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id int")
    right = spark.createDataFrame([(2,), (4,), (4,)], "id int")
    got = {tuple(r) for r in id_difference(left, right, "id", "l", "r").collect()}
    assert got == {("l", 1), ("l", 3), ("r", 4)}


def test_fingerprint_depends_on_content_only(spark):
    rows = [(i, f"n{i % 7}", None if i % 5 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    base = fingerprint(df).first()
    assert base == fingerprint(df.orderBy(F.desc("a")).repartition(7)).first()
    assert base == fingerprint(df.select("c", "a", "b")).first()
    assert base != fingerprint(df.withColumn("b", F.when(F.col("a") == 3, "x").otherwise(F.col("b")))).first()
    assert base != fingerprint(df.unionByName(df.where("a = 1"))).first()
    assert fingerprint(df.limit(0)).first().empreinte == "vide"
    alike = [("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "<null>"), ("a", "N"), ("aN", None), ("", "a")]
    prints = {fingerprint(spark.createDataFrame([r], "x string, y string")).first().empreinte for r in alike}
    assert len(prints) == len(alike)
