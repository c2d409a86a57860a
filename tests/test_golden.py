"""Fabricated rows with known answers."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.functions import (
    classify_incident, iso_week_start, lead_time_bucket, sunday_week_start, whole_hours_between,
)
from palimpsest.plans import changes as C
from palimpsest.plans import marts as M
from palimpsest.plans import staging as G


def frame(spark, schema, rows):
    """Rows given as dicts; columns that are not given are NULL."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def raw_schema(entity):
    return S.T.StructType(S.SOURCE_TABLES[entity].fields + S.LINEAGE.fields)


def ts(text):
    return dt.datetime.fromisoformat(text)


def day(text):
    return dt.date.fromisoformat(text)


def test_bookings_keep_the_last_version_and_a_clean_currency(spark):
    rows = [  # out of order; ties on the update fall to the later partition
        (71, "completed", "gbp ", "2031-03-09 17:20", "2031-03-09"),
        (71, "pending", " GBP", "2031-03-04 08:00", "2031-03-04"),
        (71, "confirmed", "Gbp", "2031-03-06 08:00", "2031-03-06"),
        (72, "pending", "\tchf", "2031-03-05 12:30", "2031-03-05"),
        (73, "pending", " usd", "2031-03-05 09:00", "2031-03-05"),
        (73, "cancelled", "usd ", "2031-03-05 09:00", "2031-03-08"),
        (74, "confirmed", None, "2031-03-07 10:10", "2031-03-07")]
    raw = frame(spark, raw_schema("bookings"), [
        dict(booking_id=b, status=s, currency=c, updated_at=ts(u), _interval_start=day(i))
        for b, s, c, u, i in rows])
    got = {(r.booking_id, r.status, r.currency) for r in G.stg_bookings(raw).collect()}
    assert {g for g in got if g[0] != 72} == {
        (71, "completed", "GBP"), (73, "cancelled", "USD"), (74, "confirmed", None)}


def test_payments_mark_double_submissions(spark):
    noon, day1 = "2031-05-02 12:00:00.000007", day("2031-05-02")
    rows = [  # three copies, a tie on the creation, another method, another booking, NULLs
        (301, 8, "transfer", noon, "2031-05-02 12:09"), (302, 8, "transfer", noon, "2031-05-02 12:03"),
        (303, 8, "transfer", noon, "2031-05-02 12:30"), (304, 8, "paypal", noon, "2031-05-02 12:04"),
        (305, 9, "transfer", noon, "2031-05-02 12:04"), (306, 9, "transfer", noon, "2031-05-02 12:04"),
        (307, 9, "transfer", None, "2031-05-02 12:05"), (308, 9, "transfer", None, "2031-05-02 12:06")]
    raw = frame(spark, raw_schema("payments"), [
        dict(payment_id=p, booking_id=b, payment_method=m, paid_at=ts(at) if at else None,
             created_at=ts(c), updated_at=ts(c), _interval_start=day1) for p, b, m, at, c in rows])
    got = {r.payment_id for r in G.stg_payments(raw).collect() if r.is_duplicate_submission}
    assert got == {301, 303, 306}


def test_replayed_copy_of_a_version_gives_the_newest_partition(spark):
    raw = frame(spark, raw_schema("customers"), [
        dict(customer_id=1, email=" A@X.fr", first_name=n, updated_at=ts("2026-09-01"),
             _interval_start=day(d))
        for n, d in [("old", "2026-09-01"), ("new", "2026-09-03")]])
    (row,) = G.stg_customer_versions(raw).collect()
    assert (row.first_name, row.email) == ("new", "a@x.fr")


def image(**fields):
    return {"booking_id": 5012, "customer_id": 88, "hotel_id": 3, "check_in": 22000,
            "check_out": 22004, "status": "pending", "total_amount": "150.25",
            "currency": "chf ", "created_at": "2031-02-01T00:00:00.5Z",
            "updated_at": "2031-02-03T06:07:08Z", **fields}


def message(offset, op, before, after, lsn):
    value = {"op": op, "ts_ms": 1_930_000_000_250, "before": before, "after": after,
             "source": {"ts_ms": 1_930_000_000_000, "snapshot": "false", "lsn": lsn, "txId": 7,
                        "table": "bookings"}}
    return ("app.public.bookings", 2, offset, '{"booking_id":5012}', json.dumps(value))


def one_key(spark):
    wait, sure, done = image(), image(status="confirmed"), image(status="completed")
    return spark.createDataFrame([
        message(40, "c", None, wait, 1000), message(41, "u", wait, sure, 1100),
        message(44, "u", sure, done, 1250), message(47, "d", done, None, 1300),
        ("app.public.bookings", 2, 48, '{"booking_id":5012}', None)], S.MESSAGE)


def test_envelope_of_a_delete(spark):
    log = C.decode_messages(one_key(spark))
    assert log.count() == 4  # the tombstone is not an event
    row = log.where("op = 'd'").first()
    assert row.after is None and json.loads(row.before)["status"] == "completed"
    assert (row.lsn, row.tx_id, row.snapshot) == (1300, 7, "false")
    assert (row.captured_at - row.source_ts) == dt.timedelta(milliseconds=250)


def test_state_after_a_delete_comes_from_the_before_image(spark):
    state = C.booking_state(C.decode_messages(one_key(spark)))
    (row,) = state.collect()
    assert row.is_deleted and row.last_op == "d" and row.booking_id == 5012
    assert row.check_in == day("2030-03-27") and str(row.total_amount) == "150.25"
    assert row.currency == "CHF"
    assert G.active_bookings(state).count() == 0


def test_transitions_show_the_intermediate_state(spark):
    log = C.decode_messages(one_key(spark))
    got = [(r.status_before, r.status_after) for r in
           C.status_transitions(log).orderBy("lsn").collect()]
    assert got[-3:] == [("pending", "confirmed"), ("confirmed", "completed"), ("completed", None)]


@pytest.mark.parametrize(("kind", "message", "expected"), [
    ("OperationalError", "the server went away", "S1"),
    ("Rejected", "too fast: RATE LIMITS of the loader", "S2a"),
    ("Rejected", "daily Quota Exceeded", "S2b"),
    ("ConnectionTimeout", None, "S1b"),
    ("OperationalError", "quota exceeded, then rate limits", "S2a"),
    ("TimeoutError", "connection timeout", None),
    (None, None, None),
])
def test_incident_classes(spark, kind, message, expected):
    df = spark.createDataFrame([(kind, message)], "kind string, message string")
    assert df.select(classify_incident(F.col("kind"), F.col("message"))).first()[0] == expected


def test_lead_time_bounds(spark):
    days = [-1, 0, 7, 8, 30, 31, 90, 91, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r[0][:1] for r in df.select(lead_time_bucket(F.col("d"))).collect()]
    assert got == ["0", "1", "1", "2", "2", "3", "3", "4", "4"]


def test_weeks_and_hours(spark):
    sunday = spark.range(1).select(
        iso_week_start(F.lit(day("2026-09-06"))), sunday_week_start(F.lit(day("2026-09-06"))),
        whole_hours_between(F.lit(ts("2026-09-01 00:59")), F.lit(ts("2026-09-01 02:01")))).first()
    assert tuple(sunday) == (day("2026-08-31"), day("2026-09-06"), 1)


def test_fixed_calendar(spark):
    dates = M.dim_dates(spark)
    assert dates.count() == 730
    sunday = dates.where("date_day = DATE '2026-09-06'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.iso_week, sunday.year_month) == (
        1, True, 36, "2026-09")


def test_null_tiers_are_not_a_change(spark):
    facts = spark.createDataFrame([(1, 1, "a"), (2, 2, None)],
                                  "booking_id int, customer_id int, customer_sk string")
    dim = spark.createDataFrame(
        [("a", 1, "gold", False), ("b", 1, "silver", True), ("c", 2, "gold", True)],
        "customer_sk string, customer_id int, loyalty_tier string, is_current boolean")
    got = {r.booking_id: r.tier_changed for r in M.with_tiers(facts, dim).collect()}
    assert got == {1: True, 2: None}
