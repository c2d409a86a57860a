"""Staging, dimension, fact and reporting models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from palimpsest.operators.compare import fingerprint
from palimpsest.plans import changes as C
from palimpsest.plans import marts as M
from palimpsest.plans import reconcile as R
from palimpsest.plans import staging as G


@query("stg_hotels", "SELECT * FROM stg_hotels", "stg_hotels")
def _(t):
    """W1 on hotels."""
    return t.stg_hotels


@query("stg_bookings", "SELECT * FROM stg_bookings", "stg_bookings")
def _(t):
    """W1, P4."""
    return t.stg_bookings


@query("stg_customer_versions", "SELECT * FROM versions", "versions")
def _(t):
    """W3, P5."""
    return t.versions


@query("stg_customers", "SELECT * FROM stg_customers", "stg_customers")
def _(t):
    """W4."""
    return t.stg_customers


@query("stg_payments", "SELECT * FROM stg_payments", "stg_payments")
def _(t):
    """W1, W6."""
    return t.stg_payments


@query("legacy_dedup", """
    SELECT DISTINCT ON (customer_id) customer_id, first_name, last_name, email, loyalty_tier,
           created_at, updated_at, _interval_start
    FROM raw_customers ORDER BY customer_id, updated_at DESC, _ingested_at DESC""", "raw_customers")
def _(t):
    """W2, P2."""
    return G.latest_by_ingestion(t.raw_customers, "customer_id")


REDUNDANCY = " UNION ALL ".join(
    f"SELECT '{n}' AS t, CAST(count(*) AS BIGINT) AS lignes_brutes, "
    f"CAST(count(DISTINCT {k}) AS BIGINT) AS cles_distinctes, "
    f"CAST(count(DISTINCT _source_file) AS BIGINT) AS fichiers, "
    f"round(count(*) / count(DISTINCT {k}), 2) AS redondance FROM raw_{n}"
    for n, k in [("hotels", "hotel_id"), ("customers", "customer_id"),
                 ("bookings", "booking_id"), ("payments", "payment_id")])


@query("dedup_ratio", REDUNDANCY, "raw_hotels raw_customers raw_bookings raw_payments")
def _(t):
    """A2, A25."""
    parts = [
        R.redundancy(t.raw_hotels, "hotels", "hotel_id"),
        R.redundancy(t.raw_customers, "customers", "customer_id"),
        R.redundancy(t.raw_bookings, "bookings", "booking_id"),
        R.redundancy(t.raw_payments, "payments", "payment_id")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("rows_raw_vs_staging", " UNION ALL ".join(
    f"SELECT '{n}' AS t, (SELECT count(*) FROM raw_{n}) AS raw, "
    f"(SELECT count(*) FROM stg_{n}) AS staging"
    for n in ("customers", "hotels", "bookings", "payments")),
    "raw_hotels raw_customers raw_bookings raw_payments "
    "stg_hotels stg_customers stg_bookings stg_payments")
def _(t):
    """A3."""
    return R.rows_raw_vs_staging({
        "customers": (t.raw_customers, t.stg_customers), "hotels": (t.raw_hotels, t.stg_hotels),
        "bookings": (t.raw_bookings, t.stg_bookings),
        "payments": (t.raw_payments, t.latest_payments)})


PAYMENT_COLUMNS = [
    "payment_id", "booking_id", "amount", "payment_method", "status", "paid_at", "created_at",
    "updated_at"]


def _fingerprint_sql(name: str, columns: list[str]) -> str:
    text = " || ".join(
        f"coalesce('V' || length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')"
        for c in sorted(columns))
    part = "CAST(sum(CAST(('0x' || substr(h, {0}, 15)) AS BIGINT)) AS DECIMAL(38,0))"
    return (
        f"SELECT '{name}' AS t, CAST(count(*) AS BIGINT) AS lignes, "
        f"md5(CAST({part.format(1)} AS VARCHAR) || '|' || CAST({part.format(17)} AS VARCHAR)) "
        f"AS empreinte FROM (SELECT md5({text}) AS h FROM {name})")


@query("fingerprint", " UNION ALL ".join([
    _fingerprint_sql("stg_hotels", [
        "hotel_id", "name", "city", "country", "stars", "created_at", "updated_at"]),
    _fingerprint_sql("stg_bookings", [
        "booking_id", "customer_id", "hotel_id", "check_in", "check_out", "status",
        "total_amount", "currency", "created_at", "updated_at"]),
    _fingerprint_sql("stg_customers", [
        "customer_id", "first_name", "last_name", "email", "loyalty_tier", "created_at",
        "updated_at"]),
    _fingerprint_sql("stg_payments", PAYMENT_COLUMNS),
]), "stg_hotels stg_bookings stg_customers stg_payments")
def _(t):
    """Order-free content fingerprint per table."""
    parts = [
        fingerprint(df).select(F.lit(name).alias("t"), "lignes", "empreinte")
        for name, df in [("stg_hotels", t.stg_hotels), ("stg_bookings", t.stg_bookings),
                         ("stg_customers", t.stg_customers),
                         ("stg_payments", t.stg_payments.select(PAYMENT_COLUMNS))]]
    return reduce(DataFrame.unionByName, parts)


@query("dim_customers", "SELECT * FROM dim_customers", "dim_customers")
def _(t):
    """W7, F2."""
    return t.dim_customers


@query("scd2_census", """
    SELECT count(*) AS versions, count(DISTINCT customer_id) AS clients,
           count(*) FILTER (WHERE NOT is_current) AS versions_anciennes
    FROM dim_customers""", "dim_customers")
def _(t):
    """A15."""
    return t.dim_customers.agg(
        F.count("*").alias("versions"), F.countDistinct("customer_id").alias("clients"),
        F.count_if(~F.col("is_current")).alias("versions_anciennes"))


@query("customer_versions_cdc", "SELECT * FROM customer_versions_cdc", "customer_versions_cdc")
def _(t):
    """Versions by event time, from the change log."""
    return C.customer_versions(t.customer_log)


@query("fct_asof_history", """
    SELECT f.booking_id, f.customer_id,
           coalesce((SELECT arg_max(v.loyalty_tier, v.updated_at) FROM customer_versions_cdc v
                     WHERE v.customer_id = f.customer_id AND v.updated_at <= f.created_at),
                    (SELECT arg_min(v.loyalty_tier, v.updated_at) FROM customer_versions_cdc v
                     WHERE v.customer_id = f.customer_id)) AS loyalty_tier
    FROM stg_bookings f""", "customer_versions_cdc stg_bookings")
def _(t):
    """J2 in its linear as-of form, over a history of unbounded length."""
    history = M.dim_customers(C.customer_versions(t.customer_log))
    joined = M.with_customer_version(
        t.stg_bookings, history, payload=("loyalty_tier",), unbounded_history=True)
    return joined.select("booking_id", "customer_id", "loyalty_tier")


@query("dim_dates", """
    SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%Y-%m') AS year_month, CAST(weekofyear(d) AS INTEGER) AS iso_week,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(min(CAST(created_at AS DATE)), max(check_out),
                                        INTERVAL 1 DAY)) AS d FROM raw_bookings)""", "raw_bookings")
def _(t):
    """The calendar over the range that the bookings span."""
    return M.calendar(t.raw_bookings.agg(
        F.to_date(F.min("created_at")).alias("start"), F.max("check_out").alias("end")))


@query("dim_hotels", "SELECT * FROM dim_hotels", "dim_hotels")
def _(t):
    return t.dim_hotels


@query("int_payments", "SELECT * FROM paid", "paid")
def _(t):
    """A1, P6."""
    return t.paid


@query("fct_bookings", "SELECT * FROM facts", "facts")
def _(t):
    """J1, J2, P7-P10, F5, F6."""
    return t.facts


@query("orphan_payments", "SELECT * FROM orphans", "orphans")
def _(t):
    """J6."""
    return t.orphans


@query("rpt_bookings", "SELECT * FROM rpt", "rpt")
def _(t):
    """J3-J5, P11-P14, F7."""
    return t.rpt
