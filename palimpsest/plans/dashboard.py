"""Report metrics over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.functions import iso_week_start, lead_time_bucket


def _money(c: Column) -> Column:
    return F.sum(c).cast(S.MONEY_SUM)


def revenue_by_city_month(facts: DataFrame, hotels: DataFrame) -> DataFrame:
    """D1. Summed per hotel first, so that the join is small and a busy hotel
    is reduced before it is exchanged."""
    per_hotel = (
        facts.where(F.col("status").isin(S.REVENUE_STATUSES))
        .groupBy("hotel_id", F.date_format("booking_date", "yyyy-MM").alias("year_month"))
        .agg(F.sum("total_amount").alias("amount")))
    return (
        per_hotel.join(hotels.select("hotel_id", "city"), "hotel_id", "left")
        .groupBy("city", "year_month").agg(_money(F.col("amount")).alias("revenue")))


def cancellation_rate_by_week(facts: DataFrame) -> DataFrame:
    """D2. Pending bookings are not in the denominator."""
    cancelled = F.count_if(F.col("status") == "cancelled")
    base = F.count_if(F.col("status").isin(S.CANCELLATION_BASE))
    return facts.groupBy(iso_week_start(F.col("booking_date")).alias("booking_week")).agg(
        cancelled.alias("cancelled"), base.alias("base"),
        F.round(F.try_divide(cancelled, base), 6).alias("cancellation_rate"))


def lead_time_distribution(facts: DataFrame) -> DataFrame:
    """D3."""
    return facts.groupBy(lead_time_bucket(F.col("lead_time_days")).alias("lead_time_bucket")).agg(
        F.count("*").alias("bookings"), F.min("lead_time_days").alias("min_days"),
        F.max("lead_time_days").alias("max_days"))


def revenue_by_tier(tiered: DataFrame) -> DataFrame:
    """Revenue by tier at booking beside revenue by tier today.

    Each booking contributes once to either tier in a single pass; two
    aggregates and a full join would read the fact twice.
    """
    amount = F.col("total_amount")
    zero = F.lit(0).cast(S.MONEY)
    changed = F.coalesce(F.col("tier_changed"), F.lit(False))
    shares = F.array(
        F.struct(F.col("tier_at_booking").alias("tier"), amount.alias("then"), zero.alias("now"),
                 changed.cast("int").alias("moved")),
        F.struct(F.col("tier_current").alias("tier"), zero.alias("then"), amount.alias("now"),
                 F.lit(0).alias("moved")))
    totals = (
        tiered.where(F.col("status").isin(S.REVENUE_STATUSES))
        .select(F.explode(shares).alias("s")).select("s.*")
        .groupBy("tier").agg(
            _money(F.col("then")).alias("revenue_at_booking"),
            _money(F.col("now")).alias("revenue_current"),
            F.sum("moved").alias("bookings_changed")))
    delta = F.try_divide(
        (F.col("revenue_current") - F.col("revenue_at_booking")).cast("double"),
        F.col("revenue_at_booking").cast("double"))
    return totals.withColumn("delta_pct", F.round(100 * delta, 2))


def booked_vs_paid(facts: DataFrame, orphans: DataFrame) -> DataFrame:
    """D5 in one row; facts and orphans are tagged and reduced together."""
    booked = facts.select(
        F.lit(False).alias("orphan"), "total_amount", "amount_paid",
        (F.col("payments_count") == 0).alias("unpaid"), F.col("is_overpaid").alias("overpaid"))
    lost = orphans.select(F.lit(True).alias("orphan"))
    rows = booked.unionByName(lost, allowMissingColumns=True)
    return rows.agg(
        _money(F.col("total_amount")).alias("booked"), _money(F.col("amount_paid")).alias("paid"),
        F.count_if("unpaid").alias("unpaid_bookings"),
        F.count_if("overpaid").alias("overpaid_bookings"),
        F.count_if("orphan").alias("orphan_payments"))


def monthly_star(facts: DataFrame) -> DataFrame:
    """A31."""
    return facts.groupBy(F.date_format("booking_date", "yyyy-MM").alias("year_month")).agg(
        F.count("*").alias("bookings"), _money(F.col("total_amount")).alias("booked"),
        _money(F.col("amount_paid")).alias("paid"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled"))


def unpaid_by_status(facts: DataFrame) -> DataFrame:
    """A32."""
    return facts.groupBy("status").agg(
        F.count_if(F.col("payments_count") == 0).alias("unpaid"), F.count("*").alias("bookings"))


def tier_mismatch(tiered: DataFrame) -> DataFrame:
    """What a join to the current tier would get wrong."""
    return tiered.agg(
        F.count("*").alias("reservations"),
        F.count_if(F.col("customer_sk").isNull()).alias("sans_version"),
        F.count_if("tier_changed").alias("niveau_different"),
        F.count_if("is_late_arriving_customer").alias("clients_tardifs"))


def bookings_before_customer(bookings: DataFrame, customers: DataFrame) -> DataFrame:
    """Bookings made before their customer existed, and the total.

    Only the earliest and latest creation matter for most reports, but the
    count is exact: bookings are grouped to (customer, instant) before the
    join, which caps what a hot customer sends.
    """
    grouped = bookings.groupBy("customer_id", "created_at").agg(F.count("*").alias("n"))
    c = customers.select("customer_id", F.col("created_at").alias("customer_since"))
    return grouped.join(c, "customer_id").agg(
        F.sum(F.when(F.col("created_at") < F.col("customer_since"), F.col("n")).otherwise(0))
        .alias("early"),
        F.sum("n").alias("total"))


def bookings_per_customer(customers: DataFrame, bookings: DataFrame) -> DataFrame:
    """Average bookings per customer by tier, customers without any included."""
    made = bookings.groupBy("customer_id").agg(F.count("*").alias("n"))
    return (
        customers.select("customer_id", "loyalty_tier").join(made, "customer_id", "left")
        .groupBy("loyalty_tier").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("bookings"), F.count("*").alias("customers"))
        .withColumn("per_customer", F.round(F.col("bookings") / F.col("customers"), 6)))


def stale_pending(bookings: DataFrame, as_of: str) -> DataFrame:
    """Pending bookings whose stay is over, and the total."""
    return bookings.agg(
        F.count_if((F.col("check_out") < F.lit(as_of).cast("date"))
                   & (F.col("status") == "pending")).alias("stale"),
        F.count("*").alias("total"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """A16."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def distinct_days(bookings: DataFrame) -> DataFrame:
    """A19."""
    return bookings.agg(F.countDistinct(F.to_date("created_at")).alias("days"))
