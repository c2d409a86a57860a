"""Report metrics (D1-D5 and the analyst queries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from palimpsest.plans import dashboard as D


@query("rev_city_month", """
    SELECT city, year_month, CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
    FROM rpt WHERE status IN ('confirmed', 'completed') GROUP BY ALL""", "rpt")
def _(t):
    """D1."""
    return D.revenue_by_city_month(t.base_facts, t.dim_hotels)


@query("cancel_rate_week", """
    SELECT booking_week, count(*) FILTER (WHERE status = 'cancelled') AS cancelled,
           count(*) FILTER (WHERE status <> 'pending') AS base,
           round(count(*) FILTER (WHERE status = 'cancelled')
                 / nullif(count(*) FILTER (WHERE status <> 'pending'), 0), 6) AS cancellation_rate
    FROM rpt GROUP BY booking_week""", "rpt")
def _(t):
    """D2."""
    return D.cancellation_rate_by_week(t.base_facts)


@query("lead_time_dist", """
    SELECT lead_time_bucket, count(*) AS bookings, min(lead_time_days) AS min_days,
           max(lead_time_days) AS max_days FROM rpt GROUP BY 1""", "rpt")
def _(t):
    """D3."""
    return D.lead_time_distribution(t.base_facts)


@query("rev_by_tier", """
    SELECT tier, CAST(a.m AS DECIMAL(20,2)) AS revenue_at_booking,
           CAST(c.m AS DECIMAL(20,2)) AS revenue_current, CAST(a.moved AS BIGINT) AS bookings_changed,
           round(100 * (CAST(c.m - a.m AS DOUBLE) / CAST(a.m AS DOUBLE)), 2) AS delta_pct
    FROM (SELECT tier_at_booking AS tier, sum(total_amount) AS m,
                 count(*) FILTER (WHERE tier_changed) AS moved
          FROM tiered WHERE status IN ('confirmed', 'completed') GROUP BY 1) a
    FULL JOIN (SELECT tier_current AS tier, sum(total_amount) AS m
               FROM tiered WHERE status IN ('confirmed', 'completed') GROUP BY 1) c
    USING (tier)""", "tiered")
def _(t):
    """D4."""
    return D.revenue_by_tier(t.tiered)


@query("booked_vs_paid", """
    SELECT CAST(sum(total_amount) AS DECIMAL(20,2)) AS booked,
           CAST(sum(amount_paid) AS DECIMAL(20,2)) AS paid,
           count(*) FILTER (WHERE payments_count = 0) AS unpaid_bookings,
           count(*) FILTER (WHERE is_overpaid) AS overpaid_bookings,
           (SELECT count(*) FROM orphans) AS orphan_payments
    FROM facts""", "facts orphans")
def _(t):
    """D5."""
    return D.booked_vs_paid(t.kept_paid_facts, t.kept_orphans)


@query("monthly_star", """
    SELECT strftime(booking_date, '%Y-%m') AS year_month, count(*) AS bookings,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS booked,
           CAST(sum(amount_paid) AS DECIMAL(20,2)) AS paid,
           count(*) FILTER (WHERE status = 'cancelled') AS cancelled
    FROM facts GROUP BY 1""", "facts")
def _(t):
    """A31."""
    return D.monthly_star(t.paid_facts)


@query("unpaid_by_status", """
    SELECT status, count(*) FILTER (WHERE payments_count = 0) AS unpaid, count(*) AS bookings
    FROM facts GROUP BY 1""", "facts")
def _(t):
    """A32."""
    return D.unpaid_by_status(t.paid_facts)


@query("tier_mismatch", """
    SELECT count(*) AS reservations, count(*) FILTER (WHERE customer_sk IS NULL) AS sans_version,
           count(*) FILTER (WHERE tier_changed) AS niveau_different,
           count(*) FILTER (WHERE is_late_arriving_customer) AS clients_tardifs
    FROM tiered""", "tiered")
def _(t):
    """J14."""
    return D.tier_mismatch(t.tiered)


@query("early_bookings", """
    SELECT CAST(count(*) FILTER (WHERE b.created_at < c.created_at) AS BIGINT) AS early,
           count(*) AS total
    FROM stg_bookings b JOIN stg_customers c USING (customer_id)""", "stg_bookings stg_customers")
def _(t):
    """J15."""
    return D.bookings_before_customer(t.stg_bookings, t.stg_customers)


@query("bookings_per_customer", """
    SELECT loyalty_tier, count(b.booking_id) AS bookings,
           count(DISTINCT c.customer_id) AS customers,
           round(count(b.booking_id) / count(DISTINCT c.customer_id), 6) AS per_customer
    FROM stg_customers c LEFT JOIN stg_bookings b USING (customer_id) GROUP BY 1""",
       "stg_bookings stg_customers")
def _(t):
    """J16."""
    return D.bookings_per_customer(t.stg_customers, t.stg_bookings)


@query("stale_pending", """
    SELECT count(*) FILTER (WHERE check_out < DATE '2000-01-01' AND status = 'pending') AS stale,
           count(*) AS total FROM stg_bookings""", "stg_bookings")
def _(t):
    """P24, A18."""
    return D.stale_pending(t.stg_bookings, "2000-01-01")


@query("column_histogram", "SELECT currency, count(*) AS n FROM raw_bookings GROUP BY 1",
       "raw_bookings")
def _(t):
    """A16."""
    return D.histogram(t.raw_bookings, "currency")


@query("distinct_days", """
    SELECT count(DISTINCT CAST(created_at AS DATE)) AS days FROM stg_bookings""", "stg_bookings")
def _(t):
    """A19."""
    return D.distinct_days(t.stg_bookings)


@query("revenue_share_by_view", """
    SELECT country, stars, tier_at_booking, is_unpaid, count(*) AS bookings,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue
    FROM rpt WHERE status IN ('confirmed', 'completed') GROUP BY ALL""", "rpt")
def _(t):
    """P25: a question answered over the reporting view itself."""
    return (
        t.rpt.where(F.col("status").isin("confirmed", "completed"))
        .groupBy("country", "stars", "tier_at_booking", "is_unpaid")
        .agg(F.count("*").alias("bookings"),
             F.sum("total_amount").cast("decimal(20,2)").alias("revenue")))


def flagship(t):
    """Revenue by tier as of the booking beside revenue by tier today."""
    return D.revenue_by_tier(t.tiered)


