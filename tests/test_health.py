"""Event log scans and freshness limits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import quality as Q
from palimpsest.operators.volume import volume_spikes
from palimpsest.plans import health as H
from palimpsest.session import work_dir
from palimpsest.sources import event_lines as L
from palimpsest.sources.raw import WindowError


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GOOD = '{"horodatage":"2026-09-10T10:00:00+00:00","evenement":"succes","dag_id":"d","nouveau":1}'


def test_broken_lines_are_counted_not_lost(spark):
    got = H.parse_lines(lines(
        spark, GOOD, GOOD[:30], '{"evenement":"succes"}',
        '{"horodatage":"hier","evenement":"echec"}')).collect()
    assert [r.rejected for r in got] == [False, True, True, True]


def test_strict_scan_fails(spark):
    path = work_dir(spark, "lines")
    lines(spark, GOOD, GOOD[:30]).write.text(path)
    assert L.read_tolerant(spark, path).where("rejected").count() == 1
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        L.read_strict(spark, path).collect()


def test_open_day_is_refused(spark):
    with pytest.raises(WindowError):
        L.load_day(spark, "unused", None, "2026-09-10", "2026-09-10 12:00:00", "2026-09-11")


def test_long_messages_are_cut(spark):
    attempts = spark.createDataFrame(
        [("x" * 900, 12.34)], "exception_message string, duration_s double").withColumns({
            c: F.lit(None).cast("string") for c in (
                "evenement", "dag_id", "task_id", "run_id", "exception_type")} | {
            c: F.lit("2026-01-01").cast("timestamp") for c in ("observed_at", "logical_date")} | {
            c: F.lit(1) for c in ("tentative", "retries", "relances_max")})
    row = H.shape_events(attempts).first()
    assert len(row.exception_message) == 500 and row.duree_tentative_s == 12.3


@pytest.mark.parametrize(("as_of", "status"), [
    ("2026-09-11 02:00:00", "pass"), ("2026-09-11 02:00:01", "warn"),
    ("2026-09-12 02:00:01", "error")])
def test_freshness_limits(spark, as_of, status):
    df = spark.createDataFrame([("2026-09-08",), ("2026-09-09",)], "d string")
    until = F.date_add(F.to_date("d"), 0).cast("timestamp")
    row = Q.freshness(df, "t", until + F.expr("INTERVAL 0 HOURS"), as_of, 50, 74).first()
    assert row.status == status


def test_status_follows_severity(spark):
    report = spark.createDataFrame(
        [("a", "error", 0), ("b", "error", 2), ("c", "warn", 1)],
        "check string, severity string, failures long")
    assert [r.status for r in Q.with_status(report).collect()] == ["pass", "error", "warn"]


def test_spike_needs_seven_days_and_uses_active_days(spark):
    rows = [(f"2026-09-{d:02d}", 10) for d in range(1, 7)]
    short = spark.createDataFrame(rows + [("2026-09-30", 100)], "jour string, n long")
    assert volume_spikes(short).isEmpty()
    rows.append(("2026-09-08", 20))
    enough = spark.createDataFrame(
        rows + [("2026-09-20", 40), ("2026-09-30", 41)], "jour string, n long")
    got = [(r.jour, r.mediane, r.facteur) for r in volume_spikes(enough).collect()]
    assert got == [("2026-09-30", 10.0, 4.1)]
