"""SQL of the derived tables and models, as named common table expressions.

Written independently of the DataFrame plans: DISTINCT ON, arg_max and
correlated predicates where the plans use windows and joins.
"""

from __future__ import annotations

N3 = "(VALUES (0),(1),(2)) AS vn(n)"
N2 = "(VALUES (0),(1)) AS vc(copy)"


def _lineage(name: str, day: str) -> str:
    return (
        f"CAST(({day}) + 1 AS TIMESTAMP) + INTERVAL 2 HOUR AS _ingested_at, "
        f"'{name}/dt=' || strftime({day}, '%Y-%m-%d') || '.parquet' AS _source_file, "
        f"({day}) AS _interval_start")


TIER = "CASE CAST(({0}) % 3 AS INT) WHEN 0 THEN 'standard' WHEN 1 THEN 'silver' ELSE 'gold' END"
CURRENCY = "CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN ' eur' WHEN 1 THEN 'Eur' ELSE 'EUR' END"
SETTLED = (
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'confirmed' "
    "ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'cancelled' END END")
BOOKED = (
    "CASE WHEN o_orderkey % 307 = 0 THEN CAST(0 AS DECIMAL(10,2)) "
    "ELSE CAST(o_totalprice AS DECIMAL(10,2)) END")
OD = "CAST(o_orderdate AS DATE)"
CHECK_IN = f"({OD} + CAST(o_orderkey % 120 AS INT))"
CUSTOMER_DAY = "(DATE '1994-06-01' + CAST(c_custkey % 200 + 800 * n AS INT))"
EMAIL = (
    "' User' || CAST(CASE WHEN c_custkey % 50 = 1 THEN c_custkey - 1 ELSE c_custkey END "
    "AS VARCHAR) || '@Example.com '")
SINCE = ("CASE WHEN c_custkey % 40 = 5 THEN TIMESTAMP '1996-01-01' "
         "ELSE TIMESTAMP '1994-06-01' END")
INCIDENT = (
    "CASE CAST(k % 6 AS INT) WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} "
    "WHEN 3 THEN {3} WHEN 4 THEN {4} ELSE {5} END")
KINDS = INCIDENT.format(
    "'OperationalError'", "'JobRejected'", "'JobRejected'", "'ConnectionTimeout'",
    "'DataRefused'", "'KeyError'")
TEXTS = INCIDENT.format(
    "'the database server did not answer'",
    "'rate limits hit while loading partition 7'",
    "'quota exceeded for table imports today'",
    "'no reply within 10 s'",
    "'two rows share a key'",
    "'a field is missing'")
SCENARIOS = INCIDENT.format("'S1'", "'S2a'", "'S2b'", "'S1b'", "NULL", "NULL")
STATUS4 = ("CASE CAST(({0}) % 4 AS INT) WHEN 0 THEN 'pending' WHEN 1 THEN 'confirmed' "
           "WHEN 2 THEN 'cancelled' ELSE 'completed' END")

TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_hotels": ((), f"""
        SELECT s_suppkey AS hotel_id, s_name AS name, n_name AS city,
               upper(substring(n_name, 1, 2)) AS country,
               CAST(1 + (s_suppkey + n) % 5 AS INTEGER) AS stars,
               TIMESTAMP '1994-06-01' AS created_at,
               CAST(DATE '1994-06-01' + CAST(400 * n AS INT) AS TIMESTAMP) AS updated_at,
               {_lineage('hotels', "DATE '1994-06-01' + CAST(400 * n + copy AS INT)")}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN {N3} ON n <= s_suppkey % 2 JOIN {N2} ON copy = 0 OR s_suppkey % 7 = 0"""),
    "raw_customers": ((), f"""
        SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
               {EMAIL} AS email, {TIER.format('c_custkey + n')} AS loyalty_tier,
               {SINCE} AS created_at, CAST({CUSTOMER_DAY} AS TIMESTAMP) AS updated_at,
               {_lineage('customers', CUSTOMER_DAY + ' + CAST(copy AS INT)')}
        FROM customer JOIN {N3} ON n <= c_custkey % 3 JOIN {N2} ON copy = 0 OR c_custkey % 7 = 0"""),
    "raw_bookings": ((), f"""
        SELECT o_orderkey AS booking_id, o_custkey AS customer_id, o_orderkey % 10 AS hotel_id,
               {CHECK_IN} AS check_in,
               {CHECK_IN} + CAST(1 + o_orderkey % 14 AS INT) AS check_out,
               CASE WHEN n = 0 AND o_orderkey % 2 = 1 THEN 'pending' ELSE {SETTLED} END AS status,
               {BOOKED} AS total_amount, {CURRENCY} AS currency,
               CAST({OD} AS TIMESTAMP) AS created_at,
               CAST({OD} + CAST(n AS INT) AS TIMESTAMP) AS updated_at,
               {_lineage('bookings', f"{OD} + CAST(n + copy AS INT)")}
        FROM orders JOIN {N3} ON n <= o_orderkey % 2 JOIN {N2} ON copy = 0 OR o_orderkey % 11 = 0"""),
    "raw_payments": ((), f"""
        SELECT l_orderkey * 10 + l_linenumber AS payment_id,
               CASE WHEN l_orderkey % 211 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END
                   AS booking_id,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, 'EUR' AS currency,
               CASE CAST(l_orderkey % 4 AS INT) WHEN 0 THEN 'card' WHEN 1 THEN 'transfer'
                    WHEN 2 THEN 'paypal' ELSE 'cash' END AS payment_method,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'pending'
                    WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'refunded'
                    ELSE 'captured' END AS status,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
                    ELSE CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) END AS paid_at,
               CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS created_at,
               CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS updated_at,
               {_lineage('payments', 'CAST(l_shipdate AS DATE)')}
        FROM lineitem"""),
    "booking_events": ((), f"""
        SELECT o_orderkey AS booking_id, o_custkey AS customer_id, o_orderkey % 10 AS hotel_id,
               n, CASE WHEN n > o_orderkey % 2 THEN 'd' WHEN n > 0 THEN 'u'
                       WHEN o_orderkey % 10 = 3 THEN 'r' ELSE 'c' END AS op,
               1000 + o_orderkey * 16 + n * 4 AS lsn, o_orderkey * 4 + n AS tx_id,
               CAST({OD} + CAST(n AS INT) AS TIMESTAMP) AS source_ts,
               CAST({OD} + CAST(n AS INT) AS TIMESTAMP)
                   + to_milliseconds(o_orderkey % 900 + 20) AS captured_at,
               {CHECK_IN} AS check_in,
               {CHECK_IN} + CAST(1 + o_orderkey % 14 AS INT) AS check_out,
               CASE WHEN least(n, o_orderkey % 2) = 0 AND o_orderkey % 2 = 1 THEN 'pending'
                    ELSE {SETTLED} END AS status,
               {BOOKED} AS total_amount, upper(trim({CURRENCY})) AS currency,
               CAST({OD} AS TIMESTAMP) AS created_at,
               CAST({OD} + CAST(least(n, o_orderkey % 2) AS INT) AS TIMESTAMP) AS updated_at
        FROM orders
        JOIN {N3} ON n <= o_orderkey % 2 + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END"""),
    "booking_log": (("booking_events",), f"""
        SELECT *, o.booking_id * 4 + n AS _kafka_offset,
               captured_at + INTERVAL 5 MINUTE + copy * INTERVAL 1 HOUR AS _ingested_at
        FROM booking_events o JOIN {N2} ON copy = 0 OR booking_id % 13 = 0"""),
    "event_log": ((), f"""
        SELECT *, CASE WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd'
                       ELSE 'u' END AS op,
               1000 + event_id * 16 AS lsn, event_id AS _kafka_offset,
               CAST(key % 3 AS INTEGER) AS _kafka_partition,
               ts AS source_ts, ts + to_milliseconds(event_id % 900) AS captured_at,
               ts + to_milliseconds(event_id % 900) + INTERVAL 5 MINUTE
                   + copy * INTERVAL 1 HOUR AS _ingested_at,
               {STATUS4.format('k')} AS status_new, {STATUS4.format('k + 1')} AS status_old
        FROM (SELECT *, user_id * 8 + k % 8 AS key
              FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))
        JOIN {N2} ON copy = 0 OR event_id % 10 = 0"""),
    "events_once": (("event_log",), "SELECT * FROM event_log WHERE copy = 0"),
    "customer_versions_cdc": ((), f"""
        SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
               lower(trim({EMAIL})) AS email,
               {TIER.format('c_custkey + n + 1 - step')} AS loyalty_tier, {SINCE} AS created_at,
               CAST({CUSTOMER_DAY} AS TIMESTAMP)
                   - CASE WHEN step = 0 THEN INTERVAL 6 HOUR ELSE INTERVAL 0 HOUR END AS updated_at
        FROM customer JOIN {N3} ON n <= c_custkey % 3
        JOIN (VALUES (0),(1)) AS vs(step) ON step = 1 OR n > 0"""),
    "stg_hotels": (("raw_hotels",), """
        SELECT DISTINCT ON (hotel_id) hotel_id, name, city, country, stars, created_at, updated_at
        FROM raw_hotels ORDER BY hotel_id, updated_at DESC, _interval_start DESC"""),
    "stg_bookings": (("raw_bookings",), """
        SELECT DISTINCT ON (booking_id) booking_id, customer_id, hotel_id, check_in, check_out,
               status, total_amount, upper(trim(currency)) AS currency, created_at, updated_at
        FROM raw_bookings ORDER BY booking_id, updated_at DESC, _interval_start DESC"""),
    "versions": (("raw_customers",), """
        SELECT customer_id, updated_at, arg_max(first_name, _interval_start) AS first_name,
               arg_max(last_name, _interval_start) AS last_name,
               lower(trim(arg_max(email, _interval_start))) AS email,
               arg_max(loyalty_tier, _interval_start) AS loyalty_tier,
               arg_max(created_at, _interval_start) AS created_at
        FROM raw_customers GROUP BY customer_id, updated_at"""),
    "stg_customers": (("versions",), """
        SELECT DISTINCT ON (customer_id) customer_id, first_name, last_name, email, loyalty_tier,
               created_at, updated_at
        FROM versions ORDER BY customer_id, updated_at DESC"""),
    "latest_payments": (("raw_payments",), """
        SELECT DISTINCT ON (payment_id) payment_id, booking_id, amount, currency, payment_method,
               status, paid_at, created_at, updated_at
        FROM raw_payments
        ORDER BY payment_id, updated_at DESC, _interval_start DESC, amount DESC"""),
    "stg_payments": (("latest_payments",), """
        SELECT p.*, (p.paid_at IS NOT NULL AND f.first_id <> p.payment_id) IS TRUE
                    AS is_duplicate_submission
        FROM latest_payments p LEFT JOIN (
            SELECT booking_id, payment_method, paid_at,
                   arg_min(payment_id, (created_at, payment_id)) AS first_id
            FROM latest_payments WHERE paid_at IS NOT NULL GROUP BY ALL) f
        ON p.booking_id = f.booking_id AND p.payment_method = f.payment_method
           AND p.paid_at = f.paid_at"""),
    "state": (("booking_events",), """
        SELECT booking_id, customer_id, hotel_id, check_in, check_out, status, total_amount,
               currency, created_at, updated_at, op = 'd' AS is_deleted, op AS last_op,
               lsn AS last_lsn
        FROM booking_events e
        WHERE n = (SELECT max(x.n) FROM booking_events x WHERE x.booking_id = e.booking_id)"""),
    "active": (("state",), """
        SELECT booking_id, customer_id, hotel_id, check_in, check_out, status, total_amount,
               currency, created_at, updated_at FROM state WHERE NOT is_deleted"""),
    "paid": (("stg_payments",), """
        SELECT booking_id, CAST(count(*) AS BIGINT) AS payments_count,
               CAST(count(*) FILTER (WHERE is_duplicate_submission) AS BIGINT)
                   AS duplicate_submissions_count,
               CAST(coalesce(sum(amount) FILTER (WHERE NOT is_duplicate_submission), 0)
                    AS DECIMAL(20,2)) AS amount_paid,
               min(paid_at) FILTER (WHERE NOT is_duplicate_submission) AS first_paid_at
        FROM stg_payments WHERE status = 'captured' GROUP BY booking_id"""),
    "dim_customers": (("versions",), """
        SELECT md5(CAST(customer_id AS VARCHAR) || '|' || CAST(updated_at AS VARCHAR))
                   AS customer_sk,
               customer_id, first_name, last_name, email, loyalty_tier,
               created_at AS customer_since,
               CASE WHEN updated_at > (SELECT min(x.updated_at) FROM versions x
                                       WHERE x.customer_id = v.customer_id)
                    THEN updated_at END AS valid_from,
               (SELECT min(x.updated_at) FROM versions x
                WHERE x.customer_id = v.customer_id AND x.updated_at > v.updated_at) AS valid_to,
               updated_at AS observed_from,
               NOT EXISTS (SELECT 1 FROM versions x WHERE x.customer_id = v.customer_id
                           AND x.updated_at > v.updated_at) AS is_current
        FROM versions v"""),
    "dim_hotels": (("stg_hotels",), """
        SELECT hotel_id, name AS hotel_name, city, country, stars FROM stg_hotels"""),
    "facts": (("active", "paid", "dim_customers"), """
        SELECT b.booking_id, b.customer_id, c.customer_sk,
               b.created_at < c.customer_since AS is_late_arriving_customer, b.hotel_id,
               CAST(b.created_at AS DATE) AS booking_date, b.check_in, b.check_out,
               CAST(b.check_out - b.check_in AS INTEGER) AS nights,
               CAST(b.check_in - CAST(b.created_at AS DATE) AS INTEGER) AS lead_time_days,
               b.status, b.currency, b.total_amount,
               CAST(coalesce(p.amount_paid, 0) AS DECIMAL(20,2)) AS amount_paid,
               CAST(coalesce(p.payments_count, 0) AS BIGINT) AS payments_count,
               CAST(coalesce(p.duplicate_submissions_count, 0) AS BIGINT)
                   AS duplicate_submissions_count,
               b.total_amount = 0 AS is_zero_amount,
               coalesce(p.amount_paid, 0) > b.total_amount AS is_overpaid,
               b.created_at, b.updated_at
        FROM active b LEFT JOIN paid p ON p.booking_id = b.booking_id
        LEFT JOIN dim_customers c ON c.customer_id = b.customer_id
             AND coalesce(c.valid_from, TIMESTAMP '0001-01-01') <= b.created_at
             AND coalesce(c.valid_to, TIMESTAMP '9999-01-01') > b.created_at"""),
    "orphans": (("stg_payments", "active"), """
        SELECT p.* FROM stg_payments p
        WHERE NOT EXISTS (SELECT 1 FROM active b WHERE b.booking_id = p.booking_id)"""),
    "tiered": (("facts", "dim_customers"), """
        SELECT f.*, h.loyalty_tier AS tier_at_booking, c.loyalty_tier AS tier_current,
               h.loyalty_tier <> c.loyalty_tier AS tier_changed
        FROM facts f LEFT JOIN dim_customers h ON h.customer_sk = f.customer_sk
        LEFT JOIN (SELECT * FROM dim_customers WHERE is_current) c
               ON c.customer_id = f.customer_id"""),
    "rpt": (("tiered", "dim_hotels"), """
        SELECT t.booking_id, t.booking_date,
               CAST(date_trunc('week', t.booking_date) AS DATE) AS booking_week,
               strftime(t.booking_date, '%Y-%m') AS year_month, t.check_in, t.nights,
               t.lead_time_days,
               CASE WHEN t.lead_time_days BETWEEN 0 AND 7 THEN '1. 0-7 j'
                    WHEN t.lead_time_days BETWEEN 8 AND 30 THEN '2. 8-30 j'
                    WHEN t.lead_time_days BETWEEN 31 AND 90 THEN '3. 31-90 j'
                    WHEN t.lead_time_days < 0 THEN '0. incohérent'
                    ELSE '4. > 90 j' END AS lead_time_bucket,
               t.status, h.hotel_name, h.city, h.country, h.stars, t.tier_at_booking,
               t.tier_current, t.tier_changed, t.is_late_arriving_customer, t.total_amount,
               t.amount_paid, t.payments_count, t.payments_count = 0 AS is_unpaid,
               t.duplicate_submissions_count, t.is_zero_amount, t.is_overpaid
        FROM tiered t LEFT JOIN dim_hotels h USING (hotel_id)"""),
    "calendar": ((), """
        SELECT CAST(d AS DATE) AS date_day
        FROM range(DATE '1994-01-01', DATE '2004-01-01', INTERVAL 1 DAY) AS r(d)"""),
    "rates": (("facts", "stg_payments", "orphans", "stg_customers"), """
        SELECT 'montant_zero' AS defaut, (SELECT count(*) FROM facts WHERE is_zero_amount) AS n,
               (SELECT count(*) FROM facts) AS total, 0.01::DOUBLE AS seuil
        UNION ALL SELECT 'surencaissement', (SELECT count(*) FROM facts WHERE is_overpaid),
               (SELECT count(*) FROM facts), 0.02
        UNION ALL SELECT 'client_tardif',
               (SELECT count(*) FROM facts WHERE is_late_arriving_customer),
               (SELECT count(*) FROM facts), 0.01
        UNION ALL SELECT 'double_soumission',
               (SELECT count(*) FROM stg_payments WHERE is_duplicate_submission),
               (SELECT count(*) FROM stg_payments), 0.01
        UNION ALL SELECT 'paiement_orphelin', (SELECT count(*) FROM orphans),
               (SELECT count(*) FROM stg_payments), 0.01
        UNION ALL SELECT 'email_en_double',
               (SELECT count(*) FROM (SELECT email FROM stg_customers GROUP BY 1
                                      HAVING count(*) > 1)),
               (SELECT count(*) FROM stg_customers), 0.04"""),
    "attempts": ((), f"""
        SELECT event_id, ts AS horodatage,
               CASE event_type WHEN 'error' THEN 'echec' WHEN 'click' THEN 'relance'
                    ELSE 'succes' END AS evenement,
               'dag_' || CAST(user_id % 3 AS VARCHAR) AS dag_id,
               'task_' || CAST(user_id % 4 AS VARCHAR) AS task_id,
               'run_' || CAST(event_id // 20 AS VARCHAR) AS run_id,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS logical_date,
               1 + event_id % 4 AS tentative, CAST(3 AS BIGINT) AS retries,
               CAST(3 AS BIGINT) AS relances_max, round(value, 1) AS duree_tentative_s,
               CASE WHEN event_type IN ('error', 'click') THEN {KINDS} END AS exception_type,
               CASE WHEN event_type IN ('error', 'click') THEN {TEXTS} END AS exception_message,
               CASE WHEN event_type IN ('error', 'click') THEN {SCENARIOS} END AS scenario_runbook
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)"""),
}


def sql(select: str, *needs: str) -> str:
    """A query over the named tables, with the ones it needs declared first."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in TABLES[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    declared = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name][1]})" for name in order)
    return (f"WITH {declared}\n" if declared else "") + select
