"""The platform's data tests (C1-C16, A8-A10, W8-W9) and their report.

Invariants are errors, known defects are warnings, drift of a defect is an
error. Nothing here filters or repairs: anomalies are exposed and counted.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.operators import quality as Q
from palimpsest.operators.compare import id_difference
from palimpsest.operators.history import history_defects
from palimpsest.operators.volume import below_floor, daily_volume, volume_spikes

# Highest accepted share of each known defect.
DEFECT_LIMITS = {
    "montant_zero": 0.01, "surencaissement": 0.02, "client_tardif": 0.01,
    "double_soumission": 0.01, "paiement_orphelin": 0.01, "email_en_double": 0.04,
}
# Side labels of the fact reconciliation.
MISSING_IN_FACT, MISSING_IN_STAGING = "absente du fait", "absente de staging"


def stay_ends_before_it_starts(facts: DataFrame) -> DataFrame:
    """C5."""
    return facts.where("check_out <= check_in").select("booking_id", "check_in", "check_out")


def negative_amounts(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """C6."""
    return (
        bookings.where("total_amount < 0").select(
            F.lit("reservation").alias("objet"), F.col("booking_id").alias("id"),
            F.col("total_amount").alias("montant"))
        .unionByName(payments.where("amount < 0").select(
            F.lit("paiement").alias("objet"), F.col("payment_id").alias("id"),
            F.col("amount").alias("montant"))))


def fact_vs_staging(active: DataFrame, facts: DataFrame) -> DataFrame:
    """Ids, not volumes."""
    return id_difference(active, facts, "booking_id", MISSING_IN_FACT, MISSING_IN_STAGING)


def amount_balance(payments: DataFrame, facts: DataFrame, active: DataFrame) -> DataFrame:
    """Where the captured money went (A9): one row with every part.

    Payments are summed per booking before they meet the bookings, and the
    parts are tagged and reduced in a single aggregate.
    """
    repeat = F.col("is_duplicate_submission")
    per_booking = (
        payments.where("status = 'captured'").groupBy("booking_id").agg(
            F.sum("amount").alias("captured"),
            F.sum(F.when(repeat, F.col("amount"))).alias("repeated"),
            F.sum(F.when(~repeat, F.col("amount"))).alias("counted"))
        .join(active.select("booking_id", F.lit(True).alias("known")), "booking_id", "left"))
    parts = per_booking.select(
        "captured", "repeated", F.when(F.col("known").isNull(), F.col("counted")).alias("orphaned"))
    rows = parts.unionByName(facts.select("amount_paid"), allowMissingColumns=True)
    total = S.MONEY_SUM
    zero = F.lit(0).cast(total)
    return rows.agg(
        F.sum("captured").cast(total).alias("encaisse_staging"),
        F.sum("amount_paid").cast(total).alias("encaisse_fait"),
        F.coalesce(F.sum("repeated").cast(total), zero).alias("doubles"),
        F.coalesce(F.sum("orphaned").cast(total), zero).alias("orphelins"))


def amounts_not_conserved(
    payments: DataFrame, facts: DataFrame, active: DataFrame,
) -> DataFrame:
    """One row when the parts do not add up; a NULL total is no row."""
    parts = F.col("encaisse_fait") + F.col("doubles") + F.col("orphelins")
    return (
        amount_balance(payments, facts, active)
        .select("encaisse_staging", parts.cast(S.MONEY_SUM).alias("ventile"))
        .where("encaisse_staging != ventile"))


def defect_rates(
    facts: DataFrame, payments: DataFrame, orphans: DataFrame, customers: DataFrame,
) -> DataFrame:
    """Rows per known defect and its population (A8), one pass per population."""
    def lines(df: DataFrame, total: str, **columns: str) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("defaut"), F.col(c).alias("n"), F.col(total).alias("total"))
            for name, c in columns.items()])))

    f = facts.agg(
        F.count_if("is_zero_amount").alias("zero"), F.count_if("is_overpaid").alias("over"),
        F.count_if("is_late_arriving_customer").alias("late"), F.count("*").alias("total"))
    p = (
        payments.select("is_duplicate_submission", F.lit(False).alias("orphan"))
        .unionByName(orphans.select(
            F.lit(None).cast("boolean").alias("is_duplicate_submission"),
            F.lit(True).alias("orphan")))
        .agg(F.count_if("is_duplicate_submission").alias("repeat"),
             F.count_if("orphan").alias("orphans"), F.count_if(~F.col("orphan")).alias("total")))
    c = customers.groupBy("email").agg(F.count("*").alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("shared"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return (
        lines(f, "total", montant_zero="zero", surencaissement="over", client_tardif="late")
        .unionByName(lines(p, "total", double_soumission="repeat", paiement_orphelin="orphans"))
        .unionByName(lines(c, "total", email_en_double="shared")))


def defect_drift(rates: DataFrame) -> DataFrame:
    """C11: defects above their accepted share."""
    limit = F.coalesce(*[
        F.when(F.col("defaut") == name, F.lit(float(share)))
        for name, share in DEFECT_LIMITS.items()])
    share = F.try_divide("n", "total")
    return rates.withColumn("seuil", limit).where(share > F.col("seuil")).select(
        "defaut", "n", "total", F.round(100 * share, 2).alias("pct"),
        (100 * F.col("seuil")).alias("seuil_pct"))


def row_rules() -> dict[str, dict[str, tuple[str, Column]]]:
    """All row-wise rules (C2, C3, C5, C6, C13) by table: name -> (severity, failing rows)."""
    null = lambda c: F.col(c).isNull()

    def rules(**named) -> dict[str, tuple[str, Column]]:
        return {n: rule if isinstance(rule, tuple) else ("error", rule) for n, rule in named.items()}

    return {
        "stg_hotels": rules(
            hotel_id_not_null=null("hotel_id"), stars_accepted=Q.outside("stars", S.STARS)),
        "stg_customers": rules(
            customer_id_not_null=null("customer_id"), email_not_null=null("email"),
            loyalty_tier_accepted=Q.outside("loyalty_tier", S.TIERS)),
        "stg_customers_versions": rules(
            customer_id_not_null=null("customer_id"), updated_at_not_null=null("updated_at")),
        "stg_bookings": rules(
            booking_id_not_null=null("booking_id"),
            customer_id_not_null=null("customer_id"), hotel_id_not_null=null("hotel_id"),
            status_accepted=Q.outside("status", S.BOOKING_STATUSES),
            currency_accepted=Q.outside("currency", S.CURRENCIES)),
        "stg_payments": rules(
            payment_id_not_null=null("payment_id"), booking_id_not_null=null("booking_id"),
            payment_method_accepted=Q.outside("payment_method", S.PAYMENT_METHODS),
            status_accepted=Q.outside("status", S.PAYMENT_STATUSES),
            is_duplicate_submission_not_null=null("is_duplicate_submission"),
            positive_amount=F.col("amount") < 0,
            double_submissions=("warn", F.col("is_duplicate_submission"))),
        "stg_bookings_cdc": rules(
            booking_id_not_null=null("booking_id"), is_deleted_not_null=null("is_deleted"),
            last_op_accepted=Q.outside("last_op", S.CHANGE_OPS)),
        "int_bookings_actives": rules(positive_amount=F.col("total_amount") < 0),
        "dim_hotels": rules(hotel_id_not_null=null("hotel_id")),
        "dim_customers": rules(
            customer_sk_not_null=null("customer_sk"), customer_id_not_null=null("customer_id")),
        "dim_dates": rules(date_day_not_null=null("date_day")),
        "fct_bookings": rules(
            booking_id_not_null=null("booking_id"), customer_sk_not_null=null("customer_sk"),
            stay_dates=F.col("check_out") <= F.col("check_in"),
            late_customers=("warn", F.col("is_late_arriving_customer")),
            zero_amounts=("warn", F.col("is_zero_amount")),
            overpaid=("warn", F.col("is_overpaid"))),
        "rpt_bookings_dashboard": rules(
            booking_id_not_null=null("booking_id"),
            tier_at_booking_not_null=null("tier_at_booking"),
            tier_at_booking_accepted=Q.outside("tier_at_booking", S.TIERS),
            tier_current_not_null=null("tier_current"), year_month_not_null=null("year_month")),
    }


def table_rules(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The row-wise rules of ``tables``, one pass per table."""
    return [
        Q.count_rules(tables[table], {f"{table}.{name}": rule for name, rule in rules.items()})
        for table, rules in row_rules().items() if table in tables]


UNIQUE_KEYS = {
    "stg_hotels": "hotel_id", "stg_customers": "customer_id", "stg_bookings": "booking_id",
    "stg_payments": "payment_id", "stg_bookings_cdc": "booking_id", "dim_hotels": "hotel_id",
    "dim_customers": "customer_sk", "dim_dates": "date_day", "fct_bookings": "booking_id",
    "rpt_bookings_dashboard": "booking_id",
}
RELATIONS = [
    ("stg_bookings", "customer_id", "stg_customers", "customer_id"),
    ("stg_bookings", "hotel_id", "stg_hotels", "hotel_id"),
    ("fct_bookings", "customer_id", "dim_customers", "customer_id"),
    ("fct_bookings", "customer_sk", "dim_customers", "customer_sk"),
    ("fct_bookings", "hotel_id", "dim_hotels", "hotel_id"),
    ("fct_bookings", "booking_date", "dim_dates", "date_day"),
    ("fct_bookings", "check_out", "dim_dates", "date_day"),
]


def measures(table: str) -> dict[str, Column]:
    """What a write of ``table`` counts as its rows pass (C14): failing rows of every rule, and the
    totals that checks across tables compare."""
    rules = row_rules()
    out = {f"{table}.{n}": F.count_if(rule) for n, (_, rule) in rules.get(table, {}).items()}
    captured, repeat = F.col("status") == "captured", F.col("is_duplicate_submission")
    total = lambda when: F.sum(F.when(when, F.col("amount"))).cast(S.MONEY_SUM)
    if table == "stg_bookings_cdc":  # its active rows are a view
        out |= {f"int_bookings_actives.{n}": F.count_if(~F.col("is_deleted") & rule)
                for n, (_, rule) in rules["int_bookings_actives"].items()}
    if table == "stg_payments":
        out |= {"captured": total(captured), "repeated": total(captured & repeat)}
    if table == "orphan_payments":
        out |= {"orphaned": total(captured & ~repeat)}
    if table == "fct_bookings":
        out |= {"paid": F.sum("amount_paid").cast(S.MONEY_SUM)}
    return {**out, "rows": F.count("*")}


def key_columns() -> dict[str, list[str]]:
    """Columns by table whose values the checks count: keys, references, e-mails and ids."""
    out: dict[str, list[str]] = {t: [k] for t, k in UNIQUE_KEYS.items()}
    pairs = [(c, fk) for c, fk, _, _ in RELATIONS] + [(p, pk) for _, _, p, pk in RELATIONS] + [
        ("stg_customers", "email"), ("int_bookings_actives", "booking_id")]
    for table, column in pairs:
        if column not in out.setdefault(table, []):
            out[table].append(column)
    return out


SIDES = ["int_bookings_actives.booking_id", "fct_bookings.booking_id"]


def whole_keys() -> list[str]:
    """Key columns of which the report reads every value; of the others only what occurs more than once."""
    related = [f"{c}.{fk}" for c, fk, _, _ in RELATIONS] + [f"{p}.{pk}" for _, _, p, pk in RELATIONS]
    return list(dict.fromkeys([*related, *SIDES, "stg_customers.email"]))


def key_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, value, n): how often each value of each key column occurs, one pass a table; of
    columns outside ``whole_keys`` the values that occur more than once. A hot value is a row
    per mapper before the exchange, and a row there is a number for the name and whole numbers as they are.
    """
    columns = key_columns()
    names = [f"{t}.{c}" for t, found in columns.items() for c in found] + ["versions"]
    whole = ("tinyint", "smallint", "int", "bigint")

    def pair(code: int, value: Column, kind: str) -> Column:
        return F.struct(
            F.lit(code).alias("code"),
            (value if kind in whole else F.lit(None)).cast("bigint").alias("number"),
            (F.lit(None) if kind in whole else value).cast("string").alias("text"))

    values = [
        tables[table].select(F.inline(F.array(*[
            pair(names.index(f"{table}.{c}"), F.col(c), dict(tables[table].dtypes)[c]) for c in found])))
        for table, found in columns.items()]
    values.append(tables["stg_customers_versions"].select(F.inline(F.array(pair(
        names.index("versions"), F.concat_ws("|", "customer_id", F.unix_micros("updated_at")), "string")))))
    counted = reduce(DataFrame.unionByName, values).groupBy("code", "number", "text").agg(F.count("*").alias("n"))
    read = [i for i, name in enumerate(names) if name in whole_keys()]
    return counted.where((F.col("n") > 1) | F.col("code").isin(read)).select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("code") + 1).alias("name"),
        F.coalesce("text", F.col("number").cast("string")).alias("value"), "n")


def measured_report(
    tables: Mapping[str, DataFrame], keys: DataFrame, counted: Mapping[str, Mapping], volume_floor: int,
) -> DataFrame:
    """Every check (C14, G7) of models that were counted while they were written.

    ``counted`` holds the ``measures`` of each table and ``keys`` its stored ``key_counts``. Only
    the order of versions and the daily volume are read from the models again.
    """
    spark = keys.sparkSession
    lines = [
        (f"{table}.{name}", severity, counted[table][f"{table}.{name}"])
        for table, rules in row_rules().items() for name, (severity, _) in rules.items()]
    fact, paid_in = counted["fct_bookings"], counted["stg_payments"]
    parts = [fact["paid"], counted["orphan_payments"]["orphaned"] or 0, paid_in["repeated"] or 0]
    balanced = None in (paid_in["captured"], parts[0]) or paid_in["captured"] == sum(parts)
    lines += [
        ("amounts_conserved", "error", int(not balanced)),
        ("volume_floor", "error", int(fact["rows"] < volume_floor)),
        ("orphan_payments", "warn", counted["orphan_payments"]["rows"])]
    shares = {
        "montant_zero": (fact["fct_bookings.zero_amounts"], fact["rows"]),
        "surencaissement": (fact["fct_bookings.overpaid"], fact["rows"]),
        "client_tardif": (fact["fct_bookings.late_customers"], fact["rows"]),
        "double_soumission": (paid_in["stg_payments.double_submissions"], paid_in["rows"]),
        "paiement_orphelin": (counted["orphan_payments"]["rows"], paid_in["rows"])}
    rates = spark.createDataFrame(
        [(d, n, total) for d, (n, total) in shares.items()], "defaut string, n bigint, total bigint",
    ).unionByName(keys.where("name = 'stg_customers.email'").agg(
        F.count_if(F.col("n") > 1).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).select(
        F.lit("email_en_double").alias("defaut"), "n", "total"))

    repeated = {f"{t}.{k}": f"{t}.{k}_unique" for t, k in UNIQUE_KEYS.items()} | {
        "versions": "versions_unique", "stg_customers.email": "shared_emails"}
    label = lambda named: F.coalesce(*[
        F.when(F.col("name") == k, F.lit(v)) for k, v in named.items()])
    often = keys.where(F.col("name").isin(list(repeated))).groupBy("name").agg(
        F.count_if(F.col("n") > 1).alias("failures")).select(
        label(repeated).alias("check"),
        F.when(F.col("name") == "stg_customers.email", "warn").otherwise("error").alias("severity"), "failures")
    parents = {f"{c}.{fk}": f"{p}.{pk}" for c, fk, p, pk in RELATIONS}
    named = {f"{c}.{fk}": f"{c}.{fk}_in_{p}" for c, fk, p, _ in RELATIONS}
    children = keys.where(F.col("name").isin(list(parents)) & F.col("value").isNotNull()).select(
        "name", "n", label(parents).alias("parent"), "value")
    known = keys.where(F.col("name").isin(sorted(set(parents.values()))) & F.col("value").isNotNull()).select(
        F.col("name").alias("parent"), "value")
    lost = children.join(known, ["parent", "value"], "left_anti").groupBy("name").agg(F.sum("n").alias("failures"))
    relations = spark.createDataFrame([(k, v) for k, v in named.items()], "name string, check string").join(
        lost, "name", "left").select(
        "check", F.lit("error").alias("severity"), F.coalesce("failures", F.lit(0)).alias("failures"))
    sides = keys.where(F.col("name").isin(SIDES))
    one_sided = sides.groupBy("value").agg(F.count("*").alias("sides")).where("sides = 1")
    empty = spark.createDataFrame(  # a table without rows has no key to count
        [(c, "warn" if c == "shared_emails" else "error", 0) for c in repeated.values()],
        "check string, severity string, failures bigint")
    unique = often.unionByName(empty).groupBy("check", "severity").agg(F.max("failures").alias("failures"))
    count = Q.count_failures
    return Q.with_status(reduce(DataFrame.unionByName, [
        spark.createDataFrame(lines, "check string, severity string, failures bigint"),
        unique, relations, count("fact_vs_staging", "error", one_sided),
        count("defect_rates", "error", defect_drift(rates)),
        count("versions_continuous", "error", history_defects(tables["dim_customers"])),
        count("volume_spike", "warn", volume_spikes(daily_volume(tables["fct_bookings"], "booking_date")))]))


def check_report(tables: Mapping[str, DataFrame], volume_floor: int) -> DataFrame:
    """Every check with its severity, failing rows and status.

    Takes stored tables: each check scans the columns it needs, and all
    row-wise rules of a table share one scan.
    """
    t = tables
    count = Q.count_failures
    lines = table_rules(t)
    lines += [
        count(f"{name}.{key}_unique", "error", Q.duplicated(t[name], [key]))
        for name, key in UNIQUE_KEYS.items()]
    lines += [
        Q.unmatched(t[child], fk, t[parent], pk)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        .select(F.lit(f"{child}.{fk}_in_{parent}").alias("check"),
                F.lit("error").alias("severity"), "failures")
        for child, fk, parent, pk in RELATIONS]
    rates = defect_rates(
        t["fct_bookings"], t["stg_payments"], t["orphan_payments"], t["stg_customers"])
    lines += [
        count("versions_unique", "error", Q.duplicated(
            t["stg_customers_versions"], ["customer_id", "updated_at"])),
        count("versions_continuous", "error", history_defects(t["dim_customers"])),
        count("fact_vs_staging", "error", fact_vs_staging(
            t["int_bookings_actives"], t["fct_bookings"])),
        count("amounts_conserved", "error", amounts_not_conserved(
            t["stg_payments"], t["fct_bookings"], t["int_bookings_actives"])),
        count("defect_rates", "error", defect_drift(rates)),
        count("volume_floor", "error", below_floor(t["fct_bookings"], volume_floor)),
        count("volume_spike", "warn", volume_spikes(
            daily_volume(t["fct_bookings"], "booking_date"))),
        count("shared_emails", "warn", Q.duplicated(t["stg_customers"], ["email"])),
        count("orphan_payments", "warn", t["orphan_payments"]),
    ]
    return Q.with_status(reduce(DataFrame.unionByName, lines))
