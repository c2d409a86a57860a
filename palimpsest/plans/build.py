"""Build the staging and mart tables in dependency order.

Every model that others read is stored before they read it, so no raw table is
deduplicated twice and a lost executor only repeats one model.
"""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from palimpsest.plans import changes as C
from palimpsest.plans import checks as K
from palimpsest.plans import marts as M
from palimpsest.plans import staging as G


CODEC = "zstd"  # version keys are hex digits, of which an entropy code keeps half


class Warehouse:
    """Tables as Parquet folders under one shared root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Replace the table and return it as read back: its plan is a scan."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}", compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")


    def store_counted(
        self, name: str, df: DataFrame, counts: Mapping[str, Column],
    ) -> tuple[DataFrame, dict]:
        """``store``, with aggregates over the rows taken as they are written."""
        seen, names = Observation(), list(counts)
        table = self.store(name, df.observe(seen, *[counts[n].alias(f"m{i}") for i, n in enumerate(names)]))
        try:
            found = seen.get
        except Py4JJavaError:  # a plan that Spark sees to be empty keeps no node to observe
            found = table.agg(*[counts[n].alias(f"m{i}") for i, n in enumerate(names)]).first().asDict()
        return table, {n: found[f"m{i}"] for i, n in enumerate(names)}


# Buckets of the stored models: what joins on a column shares its buckets.
BUCKETED = {
    "stg_bookings_cdc": "booking_id", "stg_payments": "booking_id", "fct_bookings": "customer_id",
    "dim_customers": "customer_id", "stg_customers_versions": "customer_id"}


class BucketedWarehouse(Warehouse):
    """Models as catalogue tables, those of ``BUCKETED`` cut into buckets of their join key.

    A join or an aggregate of two such tables on the key, or on more columns that contain it,
    needs no exchange: bucket i of one meets bucket i of the other. ``buckets`` is set for the
    largest table (some 512 MB a bucket) and is the same for all of them. A key with a third of
    the rows makes one large bucket, which adaptive execution cannot cut without an exchange:
    keep such a model in a plain ``Warehouse``.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, buckets: int):
        super().__init__(spark, root)
        self.name, self.buckets = name, buckets

    def store(self, name: str, df: DataFrame) -> DataFrame:
        table, key = f"{self.name}_{name}", BUCKETED.get(name)
        rows = df.repartition(self.buckets, key) if key else df  # one file a bucket
        writer = rows.write.mode("overwrite").option("path", f"{self.root}/{name}").option("compression", CODEC)
        if key:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        writer.saveAsTable(table)
        return self.spark.table(table)


def build_models(
    warehouse: Warehouse, raw: Mapping[str, DataFrame], booking_log: DataFrame,
    calendar: tuple[str, str], counted: dict[str, dict] | None = None,
) -> dict[str, DataFrame]:
    """All models from the raw batch tables and the bookings change log.

    ``counted``, if given, is filled with the ``measures`` of every table that is written.
    """
    store = warehouse.store
    t: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        if counted is None:
            t[name] = store(name, df)
        else:
            t[name], counted[name] = warehouse.store_counted(name, df, K.measures(name))
        return t[name]

    keep("stg_hotels", G.stg_hotels(raw["hotels"]))
    keep("stg_customers_versions", G.stg_customer_versions(raw["customers"]))
    keep("stg_customers", G.stg_customers(t["stg_customers_versions"]))
    keep("stg_bookings", G.stg_bookings(raw["bookings"]))
    keep("stg_payments", G.stg_payments(
        raw["payments"], stage=lambda df: store("latest_payments", df),
        stage_repeats=lambda df: store("repeated_payments", df)))
    keep("stg_bookings_cdc", C.booking_state(booking_log))
    # A filter over a stored table: a view costs nothing.
    t["int_bookings_actives"] = G.active_bookings(t["stg_bookings_cdc"])
    keep("dim_hotels", M.dim_hotels(t["stg_hotels"]))
    keep("dim_customers", M.dim_customers(t["stg_customers_versions"]))
    keep("dim_dates", M.dim_dates(warehouse.spark, *calendar))
    keep("fct_bookings", M.fct_bookings(
        t["int_bookings_actives"], G.payments_by_booking(t["stg_payments"]), t["dim_customers"]))
    keep("orphan_payments", M.orphan_payments(t["stg_payments"], t["int_bookings_actives"]))
    t["rpt_bookings_dashboard"] = M.rpt_bookings_dashboard(
        t["fct_bookings"], t["dim_customers"], t["dim_hotels"], t["dim_dates"])
    return t


def build_and_check(
    warehouse: Warehouse, raw: Mapping[str, DataFrame], booking_log: DataFrame,
    calendar: tuple[str, str], volume_floor: int,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The models and the report of all checks.

    Rules on rows and totals are counted while a model is written, keys of all models in one
    pass over each; of the report view only the checked columns are computed, once.
    """
    counted: dict[str, dict] = {}
    t = build_models(warehouse, raw, booking_log, calendar, counted)
    view = "rpt_bookings_dashboard"
    checked, counted[view] = warehouse.store_counted("rpt_checked", t[view].select(
        "booking_id", "tier_at_booking", "tier_current", "year_month"), K.measures(view))
    counted["int_bookings_actives"] = counted["stg_bookings_cdc"]
    keys = warehouse.store("key_counts", K.key_counts({**t, view: checked}))
    return t, K.measured_report(t, keys, counted, volume_floor)
