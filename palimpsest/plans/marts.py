"""Star schema and reporting view.

Left joins to unique keys are not dropped by the optimizer when their columns
are unused, so the fact is made of parts: a report takes the parts it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.functions import day_utc, iso_week_start, lead_time_bucket
from palimpsest.operators.history import asof_join, customer_history, interval_join


def dim_customers(versions: DataFrame) -> DataFrame:
    return customer_history(versions)


def dim_hotels(hotels: DataFrame) -> DataFrame:
    return hotels.select("hotel_id", F.col("name").alias("hotel_name"), "city", "country", "stars")


def dim_dates(
    spark: SparkSession, start: str = S.CALENDAR_START, end: str = S.CALENDAR_END,
) -> DataFrame:
    """One row per calendar day of a fixed range."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return calendar(bounds)


def calendar(bounds: DataFrame) -> DataFrame:
    """Calendar rows for a one-row frame with columns start and end."""
    d = F.col("date_day")
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date_day")).select(
        "date_day", F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("iso_week"), F.dayofweek(d).alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def booking_facts(bookings: DataFrame) -> DataFrame:
    """Columns of the fact that need no join."""
    return bookings.select(
        "booking_id", "customer_id", "hotel_id",
        day_utc(F.col("created_at")).alias("booking_date"), "check_in", "check_out",
        F.datediff("check_out", "check_in").alias("nights"),
        F.datediff("check_in", day_utc(F.col("created_at"))).alias("lead_time_days"),
        "status", "currency", "total_amount",
        (F.col("total_amount") == 0).alias("is_zero_amount"), "created_at", "updated_at")


def with_payments(facts: DataFrame, paid: DataFrame) -> DataFrame:
    """Payment measures, 0 where nothing was captured.

    Both sides are unique on the booking, so no key can be hot here.
    """
    joined = facts.join(paid.drop("first_paid_at"), "booking_id", "left")
    return joined.withColumns({
        "amount_paid": F.coalesce("amount_paid", F.lit(0).cast(S.MONEY_SUM)),
        "payments_count": F.coalesce("payments_count", F.lit(0).cast("bigint")),
        "duplicate_submissions_count":
            F.coalesce("duplicate_submissions_count", F.lit(0).cast("bigint")),
    }).withColumn("is_overpaid", F.col("amount_paid") > F.col("total_amount"))


def with_customer_version(
    facts: DataFrame, dim: DataFrame, *, payload: tuple[str, ...] = ("customer_sk",
                                                                     "customer_since"),
    unbounded_history: bool = False,
) -> DataFrame:
    """The customer version valid when the booking was made.

    ``unbounded_history`` selects the linear as-of plan, for version lists
    built from a change log where a key may have any number of versions.
    """
    if unbounded_history:
        return asof_join(
            facts, dim, "customer_id", "created_at", "observed_from", list(payload))
    return interval_join(facts, dim, "customer_id", "created_at", list(payload))


FACT_COLUMNS = [
    "booking_id", "customer_id", "customer_sk", "is_late_arriving_customer", "hotel_id",
    "booking_date", "check_in", "check_out", "nights", "lead_time_days", "status", "currency",
    "total_amount", "amount_paid", "payments_count", "duplicate_submissions_count",
    "is_zero_amount", "is_overpaid", "created_at", "updated_at",
]


def fct_bookings(
    bookings: DataFrame, paid: DataFrame, dim: DataFrame, *, unbounded_history: bool = False,
) -> DataFrame:
    """Grain: one row per booking in its last known state. Anomalies are
    exposed as flags, never filtered."""
    facts = with_payments(booking_facts(bookings), paid)
    versioned = with_customer_version(facts, dim, unbounded_history=unbounded_history)
    return versioned.withColumn(
        "is_late_arriving_customer", F.col("created_at") < F.col("customer_since")
    ).select(*FACT_COLUMNS)


def orphan_payments(payments: DataFrame, bookings: DataFrame) -> DataFrame:
    """Payments of any status whose booking does not exist."""
    return payments.join(bookings.select("booking_id"), "booking_id", "left_anti")


def with_current_tier(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Tier today beside the tier at booking.

    A booking with no version yields NULL, and a NULL tier is not a change.
    """
    now = dim.where("is_current").select("customer_id", F.col("loyalty_tier").alias("tier_current"))
    return facts.join(now, "customer_id", "left").withColumn(
        "tier_changed", F.col("tier_at_booking") != F.col("tier_current"))


def with_tiers(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Both tiers of a stored fact, looked up by its version key.

    A version belongs to one customer, so the customer is part of the join: of models that
    are bucketed by customer neither join needs an exchange.
    """
    then = dim.select("customer_id", "customer_sk", F.col("loyalty_tier").alias("tier_at_booking"))
    return with_current_tier(facts.join(then, ["customer_id", "customer_sk"], "left"), dim)


def tiered_facts(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Both tiers straight from the point-in-time join, for reports that build
    on facts without a version key: the lookup by key is not needed, and the
    second join keeps the partitioning by customer of the first."""
    versions = dim.withColumnRenamed("loyalty_tier", "tier_at_booking")
    joined = with_customer_version(
        facts, versions, payload=("customer_sk", "customer_since", "tier_at_booking"))
    return with_current_tier(joined, dim).withColumn(
        "is_late_arriving_customer", F.col("created_at") < F.col("customer_since"))


def rpt_bookings_dashboard(
    facts: DataFrame, dim: DataFrame, hotels: DataFrame, dates: DataFrame,
) -> DataFrame:
    """The one view reports read: no name, no e-mail.

    Calendar and hotels are left to the size threshold.
    """
    days = dates.select(F.col("date_day").alias("booking_date"), "year_month")
    f = (
        with_tiers(facts, dim)
        .join(hotels, "hotel_id", "left")
        .join(days, "booking_date", "left"))
    return f.select(
        "booking_id", "booking_date",
        iso_week_start(F.col("booking_date")).alias("booking_week"), "year_month",
        "check_in", "nights", "lead_time_days",
        lead_time_bucket(F.col("lead_time_days")).alias("lead_time_bucket"), "status",
        "hotel_name", "city", "country", "stars",
        "tier_at_booking", "tier_current", "tier_changed", "is_late_arriving_customer",
        "total_amount", "amount_paid", "payments_count",
        (F.col("payments_count") == 0).alias("is_unpaid"), "duplicate_submissions_count",
        "is_zero_amount", "is_overpaid")
