"""Data-quality checks and reconciliations.

Checks that must find nothing on sound data run here on rows disturbed by a
fixed rule, so that what they find can be compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.frames import CALENDAR
from catalog.registry import query
from palimpsest import schemas as S
from palimpsest.operators import quality as Q
from palimpsest.operators import volume as V
from palimpsest.operators.compare import (
    first_ids, id_difference, instant_drift, interval_verdict,
)
from palimpsest.operators.history import history_defects
from palimpsest.plans import checks as K
from palimpsest.plans import reconcile as R
from palimpsest.plans import staging as G
from palimpsest.plans.build import build_and_check


@query("chk_unique", """
    SELECT booking_id, count(*) AS n FROM raw_bookings GROUP BY 1 HAVING count(*) > 1""",
       "raw_bookings")
def _(t):
    """C1, A4."""
    return Q.duplicated(t.raw_bookings, ["booking_id"])


@query("chk_row_rules", """
    SELECT 'paid_at_not_null' AS "check", 'error' AS severity,
           count(*) FILTER (WHERE paid_at IS NULL) AS failures FROM raw_payments
    UNION ALL SELECT 'payment_method_accepted', 'error',
           count(*) FILTER (WHERE payment_method NOT IN ('card', 'paypal', 'cash'))
           FROM raw_payments
    UNION ALL SELECT 'status_accepted', 'warn', count(*) FILTER (
           WHERE status NOT IN ('pending', 'captured', 'refunded', 'failed')) FROM raw_payments
    UNION ALL SELECT 'currency_accepted', 'error',
           count(*) FILTER (WHERE currency <> 'EUR') FROM raw_bookings""",
       "raw_payments raw_bookings")
def _(t):
    """All rules of a table in one pass."""
    return Q.count_rules(t.raw_payments, {
        "paid_at_not_null": ("error", F.col("paid_at").isNull()),
        "payment_method_accepted":
            ("error", Q.outside("payment_method", ["card", "paypal", "cash"])),
        "status_accepted": ("warn", Q.outside("status", S.PAYMENT_STATUSES)),
    }).unionByName(Q.count_rules(t.raw_bookings, {
        "currency_accepted": ("error", Q.outside("currency", S.CURRENCIES))}))


@query("chk_relationships", """
    SELECT booking_id AS fk, count(*) AS n FROM stg_payments
    WHERE booking_id NOT IN (SELECT booking_id FROM active) GROUP BY 1""", "stg_payments active")
def _(t):
    """C4, J10."""
    return Q.unmatched(t.latest_payments, "booking_id", t.active, "booking_id")


@query("chk_stay_dates", """
    SELECT booking_id, check_in, check_in AS check_out FROM stg_bookings
    WHERE booking_id % 50 = 7""", "stg_bookings")
def _(t):
    """C5, with the stay of some bookings emptied."""
    disturbed = t.stg_bookings.withColumn(
        "check_out",
        F.when(F.col("booking_id") % 50 == 7, F.col("check_in")).otherwise(F.col("check_out")))
    return K.stay_ends_before_it_starts(disturbed)


@query("chk_amounts_positive", """
    SELECT 'reservation' AS objet, booking_id AS id,
           CAST(total_amount - 20000 AS DECIMAL(11,2)) AS montant
    FROM active WHERE total_amount < 20000
    UNION ALL SELECT 'paiement', payment_id, CAST(amount - 2000 AS DECIMAL(11,2))
    FROM stg_payments WHERE amount < 2000""", "active stg_payments")
def _(t):
    """C6, U1, with all amounts lowered."""
    cut = lambda c, by: (F.col(c) - F.lit(by)).cast("decimal(11,2)")
    return K.negative_amounts(
        t.active.withColumn("total_amount", cut("total_amount", 20000)),
        t.latest_payments.withColumn("amount", cut("amount", 2000)))


@query("chk_versions_unique", """
    SELECT customer_id, updated_at, count(*) AS n FROM raw_customers
    GROUP BY 1, 2 HAVING count(*) > 1""", "raw_customers")
def _(t):
    """C7, on the raw rows, where replayed versions repeat."""
    return Q.duplicated(t.raw_customers, ["customer_id", "updated_at"])


@query("scd2_continuity", """
    SELECT * FROM (WITH d AS (SELECT * FROM dim_customers
               WHERE NOT (customer_id % 10 = 2 AND valid_from IS NOT NULL AND NOT is_current)
                 AND NOT (customer_id % 10 = 1 AND is_current)
                 AND NOT (customer_id % 10 = 5 AND valid_from IS NULL AND NOT is_current))
    SELECT a.customer_id, 'trou ou chevauchement' AS probleme
    FROM d a JOIN d b ON b.customer_id = a.customer_id AND b.observed_from > a.observed_from
    WHERE b.observed_from = (SELECT min(x.observed_from) FROM d x
          WHERE x.customer_id = a.customer_id AND x.observed_from > a.observed_from)
      AND b.valid_from IS NOT NULL AND a.valid_to IS DISTINCT FROM b.valid_from
    UNION ALL SELECT customer_id, 'versions courantes != 1' FROM d GROUP BY 1
      HAVING count(*) FILTER (WHERE is_current) <> 1
    UNION ALL SELECT customer_id, 'premières versions != 1' FROM d GROUP BY 1
      HAVING count(*) FILTER (WHERE valid_from IS NULL) <> 1)""", "dim_customers")
def _(t):
    """W8, C8, with some first, middle and last versions removed."""
    c, first, last = F.col("customer_id") % 10, F.col("valid_from").isNull(), F.col("is_current")
    removed = (
        ((c == 2) & ~first & ~last) | ((c == 1) & last) | ((c == 5) & first & ~last))
    return history_defects(t.dim_customers.where(~removed))


@query("chk_fact_vs_staging", """
    SELECT 'absente du fait' AS ecart, booking_id FROM active WHERE booking_id % 100 = 3
    UNION ALL SELECT 'absente de staging', booking_id FROM active
    WHERE booking_id % 100 = 4""", "active")
def _(t):
    """C9, J7, with rows missing on either side."""
    return K.fact_vs_staging(
        t.active.where("booking_id % 100 <> 4"), t.base_facts.where("booking_id % 100 <> 3"))


BALANCE = """
    SELECT (SELECT CAST(sum(amount) AS DECIMAL(20,2)) FROM stg_payments
            WHERE status = 'captured') AS encaisse_staging,
           (SELECT CAST(sum(amount_paid) AS DECIMAL(20,2)) FROM {facts}) AS encaisse_fait,
           (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(20,2)) FROM stg_payments
            WHERE status = 'captured' AND is_duplicate_submission) AS doubles,
           (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(20,2)) FROM orphans
            WHERE status = 'captured' AND NOT is_duplicate_submission) AS orphelins"""


@query("amount_balance", BALANCE.format(facts="facts"), "stg_payments facts orphans")
def _(t):
    """A9, J8, J17."""
    return K.amount_balance(t.kept_payments, t.kept_paid_facts, t.kept_active)


@query("chk_amounts_conserved", f"""
    SELECT encaisse_staging, CAST(encaisse_fait + doubles + orphelins AS DECIMAL(20,2)) AS ventile
    FROM ({BALANCE.format(facts="(SELECT * FROM facts WHERE booking_id % 100 <> 3)")})
    WHERE encaisse_staging <> encaisse_fait + doubles + orphelins""", "stg_payments facts orphans")
def _(t):
    """C10, with bookings lost from the fact."""
    return K.amounts_not_conserved(
        t.kept_payments, t.kept_paid_facts.where("booking_id % 100 <> 3"), t.kept_active)


@query("defect_rates", "SELECT defaut, n, total FROM rates", "rates")
def _(t):
    """A8."""
    return t.defect_rates()


@query("chk_defect_rates", """
    SELECT defaut, n, total, round(100 * (n / total), 2) AS pct, 100 * seuil AS seuil_pct
    FROM rates WHERE total > 0 AND n / total > seuil""", "rates")
def _(t):
    """C11, F19."""
    return K.defect_drift(t.defect_rates())


@query("chk_volume_floor", """
    SELECT count(*) AS lignes, CAST(1000000000 AS BIGINT) AS plancher FROM active
    HAVING count(*) < 1000000000""", "active")
def _(t):
    """C12, A10."""
    return V.below_floor(t.active, 1_000_000_000)


@query("daily_volume", """
    SELECT CAST(created_at AS DATE) AS jour, count(*) AS n FROM active GROUP BY 1""", "active")
def _(t):
    """A11."""
    return V.daily_volume(t.base_facts, "booking_date")


@query("chk_volume_spike", """
    SELECT jour, n, mediane, round(n / mediane, 1) AS facteur FROM (
        SELECT jour, n, count(n) OVER w AS nb_ref, quantile_cont(n, 0.5) OVER w AS mediane
        FROM (SELECT CAST(created_at AS DATE) AS jour, count(*) AS n FROM active GROUP BY 1)
        WINDOW w AS (ORDER BY jour ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
    WHERE nb_ref >= 7 AND n > 1.5 * mediane""", "active")
def _(t):
    """C12, W9, F21; a low factor, since the test volume is even."""
    return V.volume_spikes(V.daily_volume(t.base_facts, "booking_date"), factor=1.5)


@query("chk_late_customers", """
    SELECT booking_id, customer_id FROM facts WHERE is_late_arriving_customer""", "facts")
def _(t):
    """C13, P9."""
    return t.versioned_facts.where("is_late_arriving_customer").select("booking_id", "customer_id")


@query("chk_double_submissions", """
    SELECT payment_id FROM stg_payments WHERE is_duplicate_submission""", "stg_payments")
def _(t):
    """C13."""
    return t.stg_payments.where("is_duplicate_submission").select("payment_id")


@query("chk_shared_emails", """
    SELECT email, count(*) AS clients FROM stg_customers GROUP BY 1 HAVING count(*) > 1""",
       "stg_customers")
def _(t):
    """C13, A5."""
    return Q.duplicated(t.stg_customers, ["email"], "clients")


@query("chk_zero_amounts", "SELECT booking_id FROM active WHERE total_amount = 0", "active")
def _(t):
    """C13, P7."""
    return t.base_facts.where("is_zero_amount").select("booking_id")


@query("chk_overpaid", """
    SELECT booking_id, total_amount, amount_paid FROM facts WHERE is_overpaid""", "facts")
def _(t):
    """C13, P8."""
    return t.paid_facts.where("is_overpaid").select("booking_id", "total_amount", "amount_paid")


@query("chk_freshness_batch", """
    SELECT source, loaded_until, CAST(date_sub('hour', loaded_until, as_of) AS BIGINT) AS age_hours,
           CASE WHEN as_of - loaded_until > INTERVAL 50 HOUR THEN 'error'
                WHEN as_of - loaded_until > INTERVAL 26 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT 'bookings' AS source, TIMESTAMP '2001-11-06 06:30:00' AS as_of,
                 max(CAST(_interval_start + 1 AS TIMESTAMP)) AS loaded_until FROM raw_bookings
          UNION ALL SELECT 'customers', TIMESTAMP '2001-11-06 06:30:00',
                 max(CAST(_interval_start + 1 AS TIMESTAMP)) FROM raw_customers
          UNION ALL SELECT 'payments', TIMESTAMP '2001-11-06 06:30:00',
                 max(CAST(_interval_start + 1 AS TIMESTAMP)) FROM raw_payments)""",
       "raw_bookings raw_customers raw_payments")
def _(t):
    """Age of the last loaded day, on data time."""
    until = F.date_add("_interval_start", 1).cast("timestamp")
    return reduce(DataFrame.unionByName, [
        Q.freshness(df, name, until, "2001-11-06 06:30:00", 26, 50)
        for name, df in [("bookings", t.raw_bookings), ("customers", t.raw_customers),
                         ("payments", t.raw_payments)]])


@query("chk_freshness_cdc", """
    SELECT source, loaded_until,
           CAST(date_sub('hour', loaded_until, as_of) AS BIGINT) AS age_hours,
           CASE WHEN as_of - loaded_until > INTERVAL 26 HOUR THEN 'error'
                WHEN as_of - loaded_until > INTERVAL 1 HOUR THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT 'bookings_cdc' AS source, TIMESTAMP '2024-01-31 12:00:00' AS as_of,
                 max(_ingested_at) AS loaded_until FROM event_log
          UNION ALL SELECT 'customers_cdc', TIMESTAMP '1999-05-05 12:00:00', max(
                 CAST(DATE '1994-06-01' + CAST(c_custkey % 200 + 800 * n AS INT) AS TIMESTAMP)
                 + INTERVAL 100 MILLISECOND + INTERVAL 5 MINUTE
                 + CASE WHEN c_custkey % 13 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END)
          FROM customer, (VALUES (0),(1),(2)) v(n) WHERE n <= c_custkey % 3)""", "event_log")
def _(t):
    """Every table that has a change log."""
    at = F.col("_ingested_at")
    return Q.freshness(t.event_log, "bookings_cdc", at, "2024-01-31 12:00:00", 1, 26).unionByName(
        Q.freshness(t.customer_log, "customers_cdc", at, "1999-05-05 12:00:00", 1, 26))


def _count(name: str, severity: str, failing: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{severity}' AS severity, ({failing}) AS failures"


def _rule(table: str, source: str, name: str, predicate: str, severity: str = "error") -> str:
    return _count(f"{table}.{name}", severity,
                  f"SELECT count(*) FILTER (WHERE {predicate}) FROM {source}")


def _report_sql() -> str:
    source = {
        "stg_customers_versions": "versions", "stg_bookings_cdc": "state",
        "int_bookings_actives": "active", "dim_dates": "calendar", "fct_bookings": "facts",
        "rpt_bookings_dashboard": "rpt"}

    def listed(values):
        return ", ".join(f"'{v}'" for v in values)

    null = [
        ("stg_hotels", "hotel_id"), ("stg_customers", "customer_id"), ("stg_customers", "email"),
        ("stg_customers_versions", "customer_id"), ("stg_customers_versions", "updated_at"),
        ("stg_bookings", "booking_id"), ("stg_bookings", "customer_id"),
        ("stg_bookings", "hotel_id"), ("stg_payments", "payment_id"),
        ("stg_payments", "booking_id"), ("stg_payments", "is_duplicate_submission"),
        ("stg_bookings_cdc", "booking_id"), ("stg_bookings_cdc", "is_deleted"),
        ("dim_hotels", "hotel_id"), ("dim_customers", "customer_sk"),
        ("dim_customers", "customer_id"), ("dim_dates", "date_day"),
        ("fct_bookings", "booking_id"), ("fct_bookings", "customer_sk"),
        ("rpt_bookings_dashboard", "booking_id"), ("rpt_bookings_dashboard", "tier_at_booking"),
        ("rpt_bookings_dashboard", "tier_current"), ("rpt_bookings_dashboard", "year_month")]
    accepted = [
        ("stg_customers", "loyalty_tier", S.TIERS), ("stg_bookings", "status", S.BOOKING_STATUSES),
        ("stg_bookings", "currency", S.CURRENCIES),
        ("stg_payments", "payment_method", S.PAYMENT_METHODS),
        ("stg_payments", "status", S.PAYMENT_STATUSES),
        ("stg_bookings_cdc", "last_op", S.CHANGE_OPS),
        ("rpt_bookings_dashboard", "tier_at_booking", S.TIERS)]
    lines = [_rule(t, source.get(t, t), f"{c}_not_null", f"{c} IS NULL") for t, c in null]
    lines += [_rule(t, source.get(t, t), f"{c}_accepted", f"{c} NOT IN ({listed(v)})")
              for t, c, v in accepted]
    lines += [
        _rule("stg_hotels", "stg_hotels", "stars_accepted", "stars NOT BETWEEN 1 AND 5"),
        _rule("stg_payments", "stg_payments", "positive_amount", "amount < 0"),
        _rule("stg_payments", "stg_payments", "double_submissions", "is_duplicate_submission",
              "warn"),
        _rule("int_bookings_actives", "active", "positive_amount", "total_amount < 0"),
        _rule("fct_bookings", "facts", "stay_dates", "check_out <= check_in"),
        _rule("fct_bookings", "facts", "late_customers", "is_late_arriving_customer", "warn"),
        _rule("fct_bookings", "facts", "zero_amounts", "is_zero_amount", "warn"),
        _rule("fct_bookings", "facts", "overpaid", "is_overpaid", "warn")]
    lines += [
        _count(f"{t}.{k}_unique", "error",
               f"SELECT count(*) FROM (SELECT {k} FROM {source.get(t, t)} GROUP BY 1 "
               "HAVING count(*) > 1)")
        for t, k in K.UNIQUE_KEYS.items()]
    lines += [
        _count(f"{c}.{fk}_in_{p}", "error",
               f"SELECT count(*) FROM {source.get(c, c)} WHERE {fk} IS NOT NULL AND {fk} NOT IN "
               f"(SELECT {pk} FROM {source.get(p, p)} WHERE {pk} IS NOT NULL)")
        for c, fk, p, pk in K.RELATIONS]
    lines += [
        _count("versions_unique", "error",
               "SELECT count(*) FROM (SELECT customer_id, updated_at FROM versions GROUP BY 1, 2 "
               "HAVING count(*) > 1)"),
        _count("versions_continuous", "error", """
            SELECT count(*) FROM (
                SELECT customer_id FROM (
                    SELECT *, lead(valid_from) OVER w AS following, lead(observed_from) OVER w AS seen
                    FROM dim_customers WINDOW w AS (PARTITION BY customer_id ORDER BY observed_from))
                WHERE seen IS NOT NULL AND valid_to IS DISTINCT FROM following
                UNION ALL SELECT customer_id FROM dim_customers GROUP BY 1
                HAVING count(*) FILTER (WHERE is_current) <> 1)"""),
        _count("fact_vs_staging", "error",
               "SELECT count(*) FROM active FULL JOIN facts USING (booking_id) "
               "WHERE active.customer_id IS NULL OR facts.customer_id IS NULL"),
        _count("amounts_conserved", "error",
               "SELECT count(*) FROM (" + BALANCE.format(facts="facts") + ") "
               "WHERE encaisse_staging <> encaisse_fait + doubles + orphelins"),
        _count("defect_rates", "error",
               "SELECT count(*) FROM rates WHERE total > 0 AND n / total > seuil"),
        _count("volume_floor", "error",
               "SELECT count(*) FROM (SELECT 1 FROM facts HAVING count(*) < 100)"),
        _count("volume_spike", "warn", """
            SELECT count(*) FROM (
                SELECT n, count(n) OVER w AS nb_ref, quantile_cont(n, 0.5) OVER w AS mediane
                FROM (SELECT booking_date AS jour, count(*) AS n FROM facts GROUP BY 1)
                WINDOW w AS (ORDER BY jour ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
            WHERE nb_ref >= 7 AND n > 4 * mediane"""),
        _count("shared_emails", "warn",
               "SELECT count(*) FROM (SELECT email FROM stg_customers GROUP BY 1 "
               "HAVING count(*) > 1)"),
        _count("orphan_payments", "warn", "SELECT count(*) FROM orphans")]
    return (
        'SELECT "check", severity, CAST(failures AS BIGINT) AS failures, '
        "CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ("
        + " UNION ALL ".join(lines) + ")")


@query("check_report", _report_sql(),
       "rates rpt state calendar facts orphans stg_hotels stg_bookings dim_hotels stg_payments "
       "versions dim_customers")
def _(t):
    """Build the models as tables; checks are counted as they are written."""
    raw = {"hotels": t.raw_hotels, "customers": t.raw_customers,
           "bookings": t.raw_bookings, "payments": t.raw_payments}
    return build_and_check(t.warehouse, raw, t.booking_log, CALENDAR, volume_floor=100)[1]


SOURCES = ["hotels", "customers", "bookings", "payments"]
COUNTS = " UNION ALL ".join(f"""
    SELECT '{name}' AS t, coalesce(s.d, r.d) AS _interval_start,
           CAST(coalesce(s.n, 0) AS BIGINT) AS source, CAST(coalesce(r.n, 0) AS BIGINT) AS cible
    FROM (SELECT CASE WHEN updated_at < TIMESTAMP '1996-01-01' THEN DATE '1995-12-31'
                      ELSE CAST(updated_at AS DATE) END AS d, count(*) AS n
          FROM stg_{name} WHERE updated_at < TIMESTAMP '2001-01-01' GROUP BY 1) s
    FULL JOIN (SELECT _interval_start AS d, count(*) AS n FROM raw_{name}
               WHERE _interval_start < DATE '2001-01-01' GROUP BY 1) r
    ON s.d = r.d""" for name in SOURCES)
COUNTED = " ".join(f"stg_{name} raw_{name}" for name in SOURCES)


def _source(t, name):
    """The current rows of a table; of payments without the mark of repeated submissions."""
    return t.latest_payments if name == "payments" else getattr(t, f"stg_{name}")


def _counts(t):
    return [
        (name, R.partition_counts(
            _source(t, name), getattr(t, f"raw_{name}"), "1996-01-01", "2001-01-01"))
        for name in SOURCES]


def _of_all_tables(parts):
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("t"), "*") for name, df in parts])


@query("reconcile_partitions", f"SELECT * FROM ({COUNTS}) WHERE source <> cible", COUNTED)
def _(t):
    """Days of all four tables whose counts differ."""
    return _of_all_tables(_counts(t)).where("source <> cible").orderBy("t", "_interval_start")


@query("reconcile_verdict", f"""
    SELECT *, CASE WHEN cible = 0 AND source > 0 THEN 'anomalie: partition absente'
                   WHEN cible < source THEN 'anomalie: chargement partiel'
                   WHEN cible > source THEN 'derive normale' ELSE 'sain' END AS verdict
    FROM ({COUNTS})""", COUNTED)
def _(t):
    """Both sides closed at the same day, in order of table and day."""
    return _of_all_tables([(name, interval_verdict(df)) for name, df in _counts(t)]).orderBy(
        "t", "_interval_start")


KEYS = {name: S.PRIMARY_KEY[name] for name in SOURCES}
DRIFT = " UNION ALL ".join(f"""
    SELECT '{name}' AS t, CASE WHEN s.{key} IS NULL THEN 'absent'
                ELSE CAST(CAST(round(epoch(r.created_at) - s.e, 3) AS DECIMAL(20,3)) AS VARCHAR)
                END AS decalage, count(*) AS n
    FROM raw_{name} r LEFT JOIN (
        SELECT {key}, epoch(created_at) + CASE WHEN {key} % 17 = 0 THEN 1.5 ELSE 0 END
               AS e FROM stg_{name} WHERE {key} % 50 <> 0) s
    ON r.{key} = s.{key} GROUP BY 2""" for name, key in KEYS.items())


@query("value_drift", DRIFT, COUNTED)
def _(t):
    """Instants of the raw rows of all tables against sources that lost and shifted some."""
    def drift(name, key):
        shifted = _source(t, name).where(f"{key} % 50 <> 0").withColumn(
            "created_at",
            F.when(F.col(key) % 17 == 0, F.expr("created_at + INTERVAL 1.5 SECONDS"))
            .otherwise(F.col("created_at")))
        return instant_drift(getattr(t, f"raw_{name}"), shifted, key, "created_at")

    return _of_all_tables([(name, drift(name, key)) for name, key in KEYS.items()])


@query("ghosts_missing", """
    SELECT cote, count(*) AS n, array_to_string(list_sort(list(booking_id))[1:10], ',') AS first_ids
    FROM (SELECT 'fantome' AS cote, booking_id FROM stg_bookings
          WHERE booking_id NOT IN (SELECT booking_id FROM active WHERE booking_id % 1000 <> 5)
          UNION ALL SELECT 'manquante', booking_id FROM active
          WHERE booking_id % 1000 <> 5 AND booking_id % 500 = 1)
    WHERE NOT (cote = 'fantome' AND booking_id % 500 = 1) GROUP BY 1""", "stg_bookings active")
def _(t):
    """Ids on one side only, and the first ten of each."""
    target = t.stg_bookings.where("booking_id % 500 <> 1")
    source = t.active.where("booking_id % 1000 <> 5")
    return first_ids(
        id_difference(target, source, "booking_id", "fantome", "manquante", "cote"),
        "booking_id", "cote")


@query("repeated_tuples", """
    SELECT CAST(count(*) - count(DISTINCT (booking_id, payment_method, paid_at)) AS BIGINT)
           AS doubles FROM latest_payments WHERE paid_at IS NOT NULL""", "latest_payments")
def _(t):
    """A7."""
    return R.repeated_tuples(t.latest_payments)


REPORTED = {"hotels": "stg_hotels", "customers": "stg_customers", "bookings": "active", "payments": "latest_payments"}
REPORT_LINES = " UNION ALL ".join(f"""
    SELECT '{name}' AS t, count(*) FILTER (WHERE cible > 0) AS partitions,
           count(*) FILTER (WHERE source <> cible) AS jours_differents,
           (SELECT count(*) FROM raw_{name}) AS lignes,
           (SELECT count(DISTINCT {KEYS[name]}) FROM raw_{name}) AS cles,
           (SELECT count(*) FROM raw_{name} r LEFT JOIN {source} s USING ({KEYS[name]})
            WHERE s.created_at IS NULL OR round(epoch(r.created_at) - epoch(s.created_at), 3) <> 0) AS decales,
           CAST(NULL AS BIGINT) AS source, CAST(NULL AS BIGINT) AS staging
    FROM (SELECT coalesce(s.n, 0) AS source, coalesce(r.n, 0) AS cible
          FROM (SELECT CASE WHEN updated_at < TIMESTAMP '1996-01-01' THEN DATE '1995-12-31'
                            ELSE CAST(updated_at AS DATE) END AS d, count(*) AS n
                FROM {source} WHERE updated_at < TIMESTAMP '2001-01-01' GROUP BY 1) s
          FULL JOIN (SELECT _interval_start AS d, count(*) AS n FROM raw_{name}
                     WHERE _interval_start < DATE '2001-01-01' GROUP BY 1) r ON s.d = r.d)"""
    for name, source in REPORTED.items())


REPORT = f"""
    SELECT *, jours_differents = 0 AND lignes = cles AND decales = 0 AS conforme FROM ({REPORT_LINES})
    UNION ALL SELECT 'doubles soumissions', NULL, NULL, NULL, NULL, NULL, a, b, a = b
    FROM (SELECT CAST(count(*) - count(DISTINCT (booking_id, payment_method, paid_at)) AS BIGINT) AS a
          FROM latest_payments WHERE paid_at IS NOT NULL),
         (SELECT count(*) FILTER (WHERE is_duplicate_submission) AS b FROM stg_payments)
    UNION ALL SELECT 'réservations', NULL, NULL, NULL, NULL, NULL, a, b, a = b
    FROM (SELECT count(*) AS a FROM active), (SELECT count(*) AS b FROM stg_bookings)"""


@query("source_report", f"""
    SELECT * FROM ({REPORT})
    UNION ALL SELECT CASE WHEN n = 0 THEN 'RÉCONCILIATION CONFORME' ELSE n || ' ÉCART(S) À EXPLIQUER' END,
           NULL, NULL, NULL, NULL, NULL, NULL, NULL, n = 0
    FROM (SELECT count(*) FILTER (WHERE NOT conforme) AS n FROM ({REPORT}))""",
       f"{COUNTED} active latest_payments")
def _(t):
    """All tables against their sources, the change-log state being that of the bookings, with
    the closing lines and the verdict. Payments and state are read several times: their columns
    that the report reads are stored first."""
    store = t.warehouse.store
    kept = {
        "payments": store("latest_payments", t.latest_payments.select(
            "payment_id", "booking_id", "payment_method", "paid_at", "created_at", "updated_at")),
        "bookings": store("active", t.active.select("booking_id", "created_at", "updated_at"))}
    return R.full_report(
        {name: kept[name] if name in kept else getattr(t, table) for name, table in REPORTED.items()},
        {name: getattr(t, f"raw_{name}") for name in REPORTED},
        G.stg_payments(t.raw_payments, stage=lambda _: kept["payments"]), t.stg_bookings,
        "1996-01-01", "2001-01-01")
