"""Staging models: one clean row per business object."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.functions import clean_currency, clean_email
from palimpsest.operators.latest import flag_repeats, latest_by


def _newest(raw: DataFrame, key: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest business version; among replayed copies the newest partition."""
    order = ["updated_at", "_interval_start", *tie_break]
    return latest_by(raw, [key], *[F.desc(c) for c in order])


def stg_hotels(raw: DataFrame) -> DataFrame:
    return _newest(raw, "hotel_id").select(*S.HOTELS.fieldNames())


def stg_bookings(raw: DataFrame) -> DataFrame:
    return _newest(raw, "booking_id").withColumn(
        "currency", clean_currency(F.col("currency"))).select(*S.BOOKINGS.fieldNames())


def stg_customer_versions(raw: DataFrame) -> DataFrame:
    """One row per version (customer, updated_at) that ingestion has seen."""
    return (
        latest_by(raw, ["customer_id", "updated_at"], F.desc("_interval_start"))
        .withColumn("email", clean_email(F.col("email")))
        .select(*S.CUSTOMERS.fieldNames()))


def stg_customers(versions: DataFrame) -> DataFrame:
    return latest_by(versions, ["customer_id"], F.desc("updated_at"))


def latest_payments(raw: DataFrame, tie_break: Sequence[str] = ("amount",)) -> DataFrame:
    """Latest version per payment, for readers that do not ask for repeated submissions."""
    return _newest(raw, "payment_id", tie_break).select(
        "payment_id", "booking_id", "amount",
        clean_currency(F.col("currency")).alias("currency"),
        "payment_method", "status", "paid_at", "created_at", "updated_at")


def stg_payments(
    raw: DataFrame, tie_break: Sequence[str] = ("amount",),
    stage: Callable[[DataFrame], DataFrame] | None = None,
    stage_repeats: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Latest version per payment; repeated submissions are flagged, not removed.

    A repeated submission has a new id but the same booking, method and
    instant. The flag is computed over all statuses; the amount is left out of
    the key on purpose, and an unpaid payment never repeats another.

    The latest versions are read twice, for the rows and for the firsts of the
    groups; ``stage`` may store them in between, so that the raw rows are
    deduplicated once, and ``stage_repeats`` the ids of the repeats.
    """
    latest = latest_payments(raw, tie_break)
    return flag_repeats(
        stage(latest) if stage else latest, "payment_id", ["booking_id", "payment_method", "paid_at"], "paid_at",
        ["created_at", "payment_id"], "is_duplicate_submission", stage_repeats)


def latest_by_ingestion(raw: DataFrame, key: str) -> DataFrame:
    """The older dedup rule (W2): physical load time breaks the ties."""
    return latest_by(raw, [key], F.desc("updated_at"), F.desc("_ingested_at")).drop(
        "_ingested_at", "_source_file")


def active_bookings(state: DataFrame) -> DataFrame:
    """The one definition of which bookings exist."""
    return state.where(~F.col("is_deleted")).drop("is_deleted", "last_op", "last_lsn")


def payments_by_booking(payments: DataFrame) -> DataFrame:
    """Captured payments per booking (A1): repeats are counted, not summed."""
    repeat = F.col("is_duplicate_submission")
    return (
        payments.where(F.col("status") == "captured")
        .groupBy("booking_id")
        .agg(
            F.count("*").alias("payments_count"),
            F.count_if(repeat).alias("duplicate_submissions_count"),
            F.sum(F.when(repeat, F.lit(0).cast(S.MONEY)).otherwise(F.col("amount")))
            .cast(S.MONEY_SUM).alias("amount_paid"),
            F.min(F.when(~repeat, F.col("paid_at"))).alias("first_paid_at")))
