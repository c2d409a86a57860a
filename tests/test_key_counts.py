"""The key counts of all models: which values are kept, and in which form."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.frames import CALENDAR, Frames
from palimpsest.plans import checks as K
from palimpsest.plans.build import Warehouse, build_models
from palimpsest.session import work_dir


def test_only_values_that_the_report_reads_are_kept(spark, sf):
    """Of a key that is only checked to be unique, what occurs more than once; of references all values."""
    t = Frames(spark, sf)
    raw = {n: getattr(t, f"raw_{n}") for n in ("hotels", "customers", "bookings", "payments")}
    models = build_models(Warehouse(spark, work_dir(spark, "keys")), raw, t.booking_log, CALENDAR)
    payments, facts = models["stg_payments"], models["fct_bookings"]
    twice = payments.orderBy("payment_id").limit(3)
    keys = K.key_counts({**models, "stg_payments": payments.unionByName(twice)})
    assert dict(keys.dtypes) == {"name": "string", "value": "string", "n": "bigint"}
    found = keys.where("name = 'stg_payments.payment_id'").collect()
    assert sorted(r["value"] for r in found) == sorted(str(r["payment_id"]) for r in twice.collect())
    assert {r["n"] for r in found} == {2}
    for column in ("booking_id", "customer_sk", "check_out"):
        wanted = facts.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
        kept = keys.where(F.col("name") == f"fct_bookings.{column}").select("value", "n")
        assert kept.exceptAll(wanted).isEmpty() and wanted.exceptAll(kept).isEmpty()
