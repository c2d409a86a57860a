"""Layout queries (S15, S18-S19, A28-A30, O3, G12) over stored copies of the fact."""

from __future__ import annotations

from catalog.registry import query
from palimpsest.plans import layout as Y

SINCE, UNTIL = "2001-07-01", "2001-08-01"
HOTEL = 3


def _copies(t, *names: str):
    """Layout copies of the fact, written once per query and read back."""
    facts = t.base_facts
    paths = Y.write_layouts(facts, t.fresh_folder("layout"), names or Y.LAYOUTS, unit="month")
    return {n: Y.read_layout(t.spark, p, facts) for n, p in paths.items()}


@query("layout_rows", " UNION ALL ".join(
    f"SELECT '{n}' AS copie, count(*) AS lignes FROM active" for n in Y.LAYOUTS), "active")
def _(t):
    """All copies hold the same rows."""
    return Y.row_counts(_copies(t))


@query("layout_r1", f"""
    SELECT hotel_id, CAST(sum(total_amount) AS DECIMAL(20,2)) AS amount FROM active
    WHERE created_at >= TIMESTAMP '{SINCE}' GROUP BY 1""", "active")
def _(t):
    """A28 R1 on the partitioned copy."""
    return Y.amount_by_hotel_since(_copies(t, "partitioned")["partitioned"], SINCE)


@query("layout_r2", f"""
    SELECT CAST(created_at AS DATE) AS booking_date,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS amount
    FROM active WHERE hotel_id = {HOTEL} GROUP BY 1""", "active")
def _(t):
    """A28 R2 on the clustered copy."""
    return Y.amount_by_day_of_hotel(_copies(t, "clustered")["clustered"], HOTEL)


@query("layout_r3", """
    SELECT CAST(created_at AS DATE) - CAST(dayofweek(created_at) AS INT) AS week,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS amount FROM active GROUP BY 1""", "active")
def _(t):
    """A28 R3, F8 on the plain copy."""
    return Y.amount_by_week(_copies(t, "plain")["plain"])


@query("layout_q1", f"""
    SELECT count(DISTINCT booking_id) AS bookings FROM active
    WHERE CAST(created_at AS DATE) BETWEEN DATE '{SINCE}' AND DATE '{UNTIL}'""", "active")
def _(t):
    """A29 Q1."""
    return Y.bookings_between(_copies(t, "partitioned")["partitioned"], SINCE, UNTIL)


@query("layout_q2", f"SELECT count(*) AS bookings FROM active WHERE hotel_id = {HOTEL}", "active")
def _(t):
    """A29 Q2."""
    return Y.bookings_of_hotel(_copies(t, "clustered")["clustered"], HOTEL)


@query("layout_q3", f"""
    SELECT hotel_id, count(DISTINCT customer_id) AS customers FROM active
    WHERE created_at >= TIMESTAMP '{SINCE}' GROUP BY 1""", "active")
def _(t):
    """A29 Q3."""
    return Y.customers_by_hotel_since(_copies(t, "clustered")["clustered"], SINCE)


@query("busiest_hotel", """
    SELECT hotel_id, count(*) AS n FROM active GROUP BY 1 ORDER BY n DESC, hotel_id LIMIT 1""",
       "active")
def _(t):
    """O3."""
    return Y.busiest_hotel(t.base_facts)


@query("layout_anchor", """
    SELECT CAST(max(created_at) AS DATE) AS fin, min(hotel_id) AS hotel FROM active""", "active")
def _(t):
    """A30."""
    return Y.anchor(t.base_facts)
