"""The model frames of one data folder, built on demand and shared by queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.plans import changes as C
from palimpsest.plans import checks as K
from palimpsest.plans import health as H
from palimpsest.plans import marts as M
from palimpsest.plans import staging as G
from palimpsest.plans.build import Warehouse
from palimpsest.session import configure, work_dir
from catalog import testdata as D

# The test orders run from 1995 to 2001, stays end within 134 days.
CALENDAR = ("1994-01-01", "2003-12-31")


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def _derived(self, make) -> DataFrame:
        return make(self.spark, self.sf_dir)

    raw_hotels = cached_property(lambda self: self._derived(D.raw_hotels))
    raw_customers = cached_property(lambda self: self._derived(D.raw_customers))
    raw_bookings = cached_property(lambda self: self._derived(D.raw_bookings))
    raw_payments = cached_property(lambda self: self._derived(D.raw_payments))
    booking_log = cached_property(lambda self: self._derived(D.booking_changes))
    customer_log = cached_property(lambda self: self._derived(D.customer_changes))
    event_log = cached_property(lambda self: self._derived(D.event_changes))
    attempts = cached_property(lambda self: self._derived(D.pipeline_attempts))

    stg_hotels = cached_property(lambda self: G.stg_hotels(self.raw_hotels))
    stg_bookings = cached_property(lambda self: G.stg_bookings(self.raw_bookings))
    latest_payments = cached_property(lambda self: G.latest_payments(self.raw_payments))
    stg_payments = cached_property(lambda self: G.stg_payments(self.raw_payments))
    versions = cached_property(lambda self: G.stg_customer_versions(self.raw_customers))
    stg_customers = cached_property(lambda self: G.stg_customers(self.versions))
    state = cached_property(lambda self: C.booking_state(self.booking_log))
    active = cached_property(lambda self: G.active_bookings(self.state))
    paid = cached_property(lambda self: G.payments_by_booking(self.stg_payments))

    dim_customers = cached_property(lambda self: M.dim_customers(self.versions))
    dim_hotels = cached_property(lambda self: M.dim_hotels(self.stg_hotels))
    dim_dates = cached_property(lambda self: M.dim_dates(self.spark, *CALENDAR))
    base_facts = cached_property(lambda self: M.booking_facts(self.active))
    paid_facts = cached_property(lambda self: M.with_payments(self.base_facts, self.paid))
    facts = cached_property(
        lambda self: M.fct_bookings(self.active, self.paid, self.dim_customers))
    orphans = cached_property(lambda self: M.orphan_payments(self.stg_payments, self.active))
    rpt = cached_property(lambda self: M.rpt_bookings_dashboard(
        self.facts, self.dim_customers, self.dim_hotels, self.dim_dates))
    events = cached_property(lambda self: H.typed_events(H.shape_events(self.attempts)))

    @cached_property
    def versioned_facts(self) -> DataFrame:
        """Facts with their customer version, without the payment join."""
        return M.with_customer_version(self.base_facts, self.dim_customers).withColumn(
            "is_late_arriving_customer", F.col("created_at") < F.col("customer_since"))

    @cached_property
    def tiered(self) -> DataFrame:
        return M.tiered_facts(self.base_facts, self.dim_customers)

    @cached_property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.spark, self.fresh_folder("tables"))

    @cached_property
    def kept_payments(self) -> DataFrame:
        """Staging payments as a table, for plans that read them several times."""
        store = self.warehouse.store
        return store("stg_payments", G.stg_payments(
            self.raw_payments, stage=lambda df: store("latest_payments", df)))

    @cached_property
    def kept_active(self) -> DataFrame:
        """Active bookings over the stored state, for the same plans."""
        return G.active_bookings(self.warehouse.store("stg_bookings_cdc", self.state))

    @cached_property
    def kept_paid_facts(self) -> DataFrame:
        return M.with_payments(
            M.booking_facts(self.kept_active), G.payments_by_booking(self.kept_payments))

    @cached_property
    def kept_orphans(self) -> DataFrame:
        return M.orphan_payments(self.kept_payments, self.kept_active)

    def defect_rates(self) -> DataFrame:
        facts = M.fct_bookings(
            self.kept_active, G.payments_by_booking(self.kept_payments), self.dim_customers)
        return K.defect_rates(facts, self.kept_payments, self.kept_orphans, self.stg_customers)

    def event_lines(self) -> DataFrame:
        """The event log as JSON text lines; one in 500 is cut short, and every
        line has a field that the schema does not know."""
        names = S.PIPELINE_EVENT.fieldNames()
        shaped = H.shape_events(self.attempts, keep=["event_id"])
        line = F.to_json(F.struct(*names, F.lit("x").alias("inconnu")))
        cut = F.col("event_id") % 500 == 499
        return shaped.select(F.when(cut, F.substring(line, 1, 40)).otherwise(line).alias("value"))

    def fresh_folder(self, purpose: str) -> str:
        return work_dir(self.spark, purpose)
