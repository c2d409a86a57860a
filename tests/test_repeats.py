"""Repeated submissions found through stored ids, against the plain way."""

from __future__ import annotations

from palimpsest.operators.latest import flag_repeats
from palimpsest.plans.build import Warehouse
from palimpsest.session import work_dir


def test_stored_repeats_flag_the_same_rows_and_leave_them_in_place(spark):
    rows = [(i, i // 3 if i % 4 else None, "card" if i % 2 else None, None if i % 7 == 0 else i // 6, i % 5)
            for i in range(300)] + [(None, 1, "card", 1, 0), (None, 2, None, None, 1)]
    df = spark.createDataFrame(rows, "id bigint, booking bigint, method string, at bigint, made bigint")
    house = Warehouse(spark, work_dir(spark, "repeats"))
    named = ("id", ["booking", "method", "at"], "at", ["made", "id"], "again")
    plain = flag_repeats(df, *named)
    found = flag_repeats(df, *named, stage=lambda ids: house.store("repeats", ids))
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert 0 < found.where("again").count() < 300 and found.columns == plain.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
