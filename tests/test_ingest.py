"""Window ingestion: refusals, replays, schema changes."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from palimpsest.operators.compare import fingerprint
from palimpsest.plans import staging as G
from palimpsest.session import work_dir
from palimpsest.sources import raw as I

AS_OF = "2002-01-01"
DAY = "1998-01-05"


@pytest.fixture(scope="module")
def bookings(spark, frames):
    """A small mutable source, stored so that tests do not repeat its plan."""
    path = work_dir(spark, "source")
    window = I.scan_window(frames.stg_bookings, "1997-12-01", "1998-03-01")
    window.write.parquet(path)
    return spark.read.schema(window.schema).parquet(path)


@pytest.fixture
def table(spark):
    root = work_dir(spark, "tables")
    return I.raw_table(spark, "bookings", f"t_{uuid.uuid4().hex}", f"{root}/raw"), f"{root}/landing"


def days(table):
    return {str(r[0]): r[1] for r in table.read().groupBy("_interval_start").count().collect()}


def load(source, table, day=DAY, **options):
    t, landing = table
    return I.ingest_window(source, "bookings", t, landing, day, AS_OF, **options)


@pytest.mark.parametrize(("day", "as_of"), [("", AS_OF), (DAY, DAY), (DAY, "1998-01-05 23:59:59")])
def test_open_or_missing_window_is_refused(bookings, table, day, as_of):
    with pytest.raises(I.WindowError):
        I.ingest_window(bookings, "bookings", table[0], table[1], day, as_of)
    assert days(table[0]) == {}


def test_running_a_window_again_changes_nothing(bookings, table):
    first = load(bookings, table)
    content = fingerprint(table[0].read().drop("_ingested_at", "_source_file")).first()
    assert load(bookings, table) == first == days(table[0])[DAY] > 0
    assert fingerprint(table[0].read().drop("_ingested_at", "_source_file")).first() == content


def test_stray_rows_are_refused_and_the_table_stays(bookings, table):
    load(bookings, table)
    before = days(table[0])
    strays = I.add_lineage(bookings.limit(5), "1998-01-06")
    with pytest.raises(I.GateError, match="outside the partition"):
        table[0].replace_day(strays, DAY)
    with pytest.raises(I.GateError, match="outside the days"):
        table[0].replace_days(strays, "1998-01-01", "1998-01-05")
    assert days(table[0]) == before


@pytest.mark.parametrize(("change", "reason"), [
    (lambda df: df.unionByName(df.limit(1)), "repeated key"),
    (lambda df: df.withColumn("booking_id", F.lit(None).cast("long")), "null key"),
    (lambda df: df.drop("booking_id"), "missing columns"),
])
def test_gate_stops_a_bad_batch(bookings, table, change, reason):
    load(bookings, table)
    before = days(table[0])
    one_day = I.scan_window(bookings, DAY, "1998-01-06")
    with pytest.raises(I.GateError, match=reason):
        load(change(one_day), table)
    assert days(table[0]) == before


def test_gate_sees_rows_outside_the_window(bookings):
    _, problems = I.gate_problems(bookings, "booking_id", DAY, "1998-01-06")
    assert any(p.startswith("outside the window") for p in problems)


def test_a_lost_column_is_refused_and_a_new_one_is_added(bookings, table):
    load(bookings, table)
    with pytest.raises(I.SchemaError, match="currency"):
        load(bookings.drop("currency"), table, "1998-01-06")
    load(bookings.withColumn("channel", F.lit("web")), table, "1998-01-06")
    got = {(str(r[0]), r[1]) for r in
           table[0].read().select("_interval_start", "channel").distinct().collect()}
    assert got == {(DAY, None), ("1998-01-06", "web")}


def test_backfill_equals_single_days_in_any_order(spark, bookings, table):
    t, landing = table
    for day in ("1998-01-07", "1998-01-05", "1998-01-06"):
        load(bookings, table, day)
    other = I.raw_table(spark, "bookings", f"t_{uuid.uuid4().hex}", work_dir(spark, "other"))
    I.backfill(bookings, "bookings", other, landing, "1998-01-05", "1998-01-07", AS_OF)
    assert t.read().where("_source_file LIKE '%/dt=1998-01-06'").count() == days(t)["1998-01-06"]
    drop = ["_ingested_at"]
    assert fingerprint(t.read().drop(*drop)).first() == fingerprint(
        other.read().drop(*drop)).first()


@pytest.mark.parametrize("broken", ["doubled", "without key"])
def test_every_load_path_has_the_gate(bookings, table, broken):
    t, landing = table
    load(bookings, table)
    before = days(t)
    bad = bookings.union(bookings) if broken == "doubled" else bookings.withColumn(
        "booking_id", F.expr("nullif(booking_id, booking_id)"))
    with pytest.raises(I.GateError, match="key"):
        I.backfill(bad, "bookings", t, landing, "1998-01-05", "1998-01-07", AS_OF)
    with pytest.raises(I.GateError, match="key"):
        I.snapshot(bad, "bookings", t, landing, "1998-01-01")
    with pytest.raises(I.GateError, match="key"):
        load(bad, table)
    assert days(t) == before


def test_backfill_leaves_other_days_alone(bookings, table):
    t, landing = table
    I.backfill(bookings, "bookings", t, landing, "1998-01-01", "1998-01-31", AS_OF)
    before = days(t)
    half = bookings.where("booking_id % 2 = 0")
    I.backfill(half, "bookings", t, landing, "1998-01-10", "1998-01-12", AS_OF)
    after = days(t)
    inside = {"1998-01-10", "1998-01-11", "1998-01-12"}
    assert {d: n for d, n in after.items() if d not in inside} == {
        d: n for d, n in before.items() if d not in inside}
    assert sum(after.get(d, 0) for d in inside) < sum(before.get(d, 0) for d in inside)


def test_backfill_warns_where_history_would_be_lost(bookings, table):
    with pytest.warns(UserWarning, match="erases row versions"):
        I.backfill(bookings, "bookings", *table, DAY, DAY, AS_OF, keeps_history=True)


def test_snapshot_runs_once_unless_forced(bookings, table):
    t, landing = table
    assert I.snapshot(bookings, "bookings", t, landing, "1998-01-01")
    before = days(t)
    assert set(before) == {"1997-12-31"}
    assert not I.snapshot(bookings.limit(1), "bookings", t, landing, "1998-01-01")
    assert days(t) == before
    half = bookings.where("booking_id % 2 = 0")
    assert I.snapshot(half, "bookings", t, landing, "1998-01-01", force=True)
    assert 0 < days(t)["1997-12-31"] < before["1997-12-31"]


def test_replay_grows_raw_but_not_staging(spark, bookings):
    """At-least-once delivery: copies pile up in raw, reads stay the same."""
    path = work_dir(spark, "raw")
    once = I.add_lineage(bookings, DAY, "1998-01-06 00:00:00")
    once.write.parquet(path)
    read = lambda: spark.read.schema(once.schema).parquet(path)
    rows, content = read().count(), fingerprint(G.stg_bookings(read())).first()
    for _ in range(2):
        once.write.mode("append").parquet(path)
    assert read().count() == 3 * rows  # or nothing was replayed
    assert fingerprint(G.stg_bookings(read())).first() == content


def test_predicates_cover_the_window_once():
    at = lambda h: dt.datetime(2026, 9, 1, h)
    cuts = I.window_predicates("2026-09-01", "2026-09-02", [(at(6), None), (at(12), None), (at(18), None)])
    assert len(cuts) == 4
    assert cuts[0].startswith("updated_at >= TIMESTAMP '2026-09-01 00:00:00")
    assert all(a.split("< ")[1] == b.split(">= ")[1].split(" AND")[0]
               for a, b in zip(cuts, cuts[1:]))
    assert cuts[-1].endswith("< TIMESTAMP '2026-09-02 00:00:00.000000'")
