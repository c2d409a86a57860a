"""The reconciliation of all tables: what it computes once."""

from __future__ import annotations

import __spark_entry__  # noqa: F401  registers the catalogue
from catalog.registry import QUERIES


def test_payments_and_state_are_deduplicated_once(spark, sf):
    """Lines that read them scan what was stored: no window over raw payments or the change log is left."""
    plan = QUERIES["source_report"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(booking_id" in plan  # staging bookings, read by one line
    for key in ("payment_id", "_key"):
        assert f"windowspecdefinition({key}" not in plan
