"""Source, raw and staging reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest import schemas as S
from palimpsest.operators.compare import count_difference, instant_drift


def window_of(updated_at: Column, start: str) -> Column:
    """Logical day of a row: the eve of ``start`` for the initial snapshot, else
    the UTC day of its last update (P18)."""
    first = F.lit(start).cast("date")
    return F.when(updated_at < first.cast("timestamp"), F.date_sub(first, 1)).otherwise(
        F.to_date(updated_at))


def partition_counts(source: DataFrame, raw: DataFrame, start: str, end: str) -> DataFrame:
    """Rows per logical day on both sides, closed days only."""
    closed = source.where(F.col("updated_at") < F.lit(end).cast("timestamp")).select(
        window_of(F.col("updated_at"), start).alias("_interval_start"))
    loaded = raw.where(F.col("_interval_start") < F.lit(end).cast("date")).select("_interval_start")
    return count_difference(closed, loaded, ["_interval_start"])


def redundancy(raw: DataFrame, table: str, key: str) -> DataFrame:
    """Rows, distinct keys and files of a raw table (A2, A25), for keys that are whole numbers.

    Two one-column passes. Keys are counted in bitmaps of 32,768 neighbours: a mapper sends
    one bitmap a bucket, however often a key occurs in it, and nothing is expanded. Files
    are as many rows as a mapper has files.
    """
    keys = raw.where(F.col(key).isNotNull()).groupBy(
        F.bitmap_bucket_number(key).alias("bucket"),
    ).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(key))).alias("cles"))
    files = raw.groupBy("_source_file").agg(F.count("*").alias("n"))
    parts = keys.agg(F.sum("cles").alias("cles_distinctes")).unionByName(
        files.agg(F.sum("n").alias("lignes_brutes"), F.count("_source_file").alias("fichiers")),
        allowMissingColumns=True)
    return parts.agg(*[
        F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("lignes_brutes", "cles_distinctes", "fichiers")
    ]).select(
        F.lit(table).alias("t"), "lignes_brutes", "cles_distinctes", "fichiers",
        F.round(F.try_divide("lignes_brutes", "cles_distinctes"), 2).alias("redondance"))


def rows_raw_vs_staging(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One line per table (A3): both sides tagged and counted together."""
    def line(name: str, raw: DataFrame, staging: DataFrame) -> DataFrame:
        both = raw.select(F.lit(True).alias("is_raw")).unionByName(
            staging.select(F.lit(False).alias("is_raw")))
        return both.agg(
            F.count_if("is_raw").alias("raw"), F.count_if(~F.col("is_raw")).alias("staging")
        ).select(F.lit(name).alias("t"), "raw", "staging")

    return reduce(DataFrame.unionByName, [line(n, *p) for n, p in pairs.items()])


def repeated_tuples(payments: DataFrame) -> DataFrame:
    """Payments beyond the first of each (booking, method, instant).

    One partial aggregate per tuple; NULL parts of the tuple compare equal.
    """
    groups = payments.where("paid_at IS NOT NULL").groupBy(
        "booking_id", "payment_method", "paid_at").agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("doubles"))


def only_in_partition(raw: DataFrame, table: str, key: str, day: str) -> DataFrame:
    """Keys that would be lost with one partition."""
    d = F.lit(day).cast("date")
    spans = raw.groupBy(key).agg(
        F.min("_interval_start").alias("first"), F.max("_interval_start").alias("last"))
    lost = F.count_if((F.col("first") == d) & (F.col("last") == d))
    return spans.agg(F.count("*").alias("cles"), lost.alias("perdues")).select(
        F.lit(table).alias("t"), "cles", "perdues",
        F.round(100 * F.try_divide("perdues", "cles"), 2).alias("pct"))


def source_report(
    table: str, key: str, source: DataFrame, raw: DataFrame, start: str, end: str,
) -> DataFrame:
    """One line per table (G8): days that differ, rows, keys, shifted instants."""
    days = partition_counts(source, raw, start, end).agg(
        F.count_if(F.col("cible") > 0).alias("partitions"),
        F.count_if(F.col("source") != F.col("cible")).alias("jours_differents"))
    keys = raw.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lignes"), F.count("*").alias("cles"))
    drift = instant_drift(raw, source, key, "created_at").agg(
        F.coalesce(F.sum(F.when(F.col("decalage") == "0.000", 0).otherwise(F.col("n"))), F.lit(0))
        .alias("decales"))
    # Three one-row frames; a tagged union keeps this free of joins.
    rows = days.unionByName(keys, allowMissingColumns=True).unionByName(
        drift, allowMissingColumns=True)
    names = ["partitions", "jours_differents", "lignes", "cles", "decales"]
    merged = rows.agg(*[F.max(n).alias(n) for n in names])
    healthy = (
        (F.col("jours_differents") == 0) & (F.col("lignes") == F.col("cles"))
        & (F.col("decales") == 0))
    return merged.select(F.lit(table).alias("t"), *names, healthy.alias("conforme"))


def closing_line(name: str, source: DataFrame, staging: DataFrame) -> DataFrame:
    """A total of the source beside the same total of staging, each a frame of one number."""
    both = source.toDF("n").select("n", F.lit(True).alias("s")).unionByName(
        staging.toDF("n").select("n", F.lit(False).alias("s")))
    return both.agg(
        F.coalesce(F.max(F.when(F.col("s"), F.col("n"))), F.lit(0)).alias("source"),
        F.coalesce(F.max(F.when(~F.col("s"), F.col("n"))), F.lit(0)).alias("staging"),
    ).select(F.lit(name).alias("t"), "source", "staging", (F.col("source") == F.col("staging")).alias("conforme"))


def full_report(
    sources: Mapping[str, DataFrame], raw: Mapping[str, DataFrame], stg_payments: DataFrame,
    stg_bookings: DataFrame, start: str, end: str,
) -> DataFrame:
    """The whole reconciliation (G8): a line a table, repeated submissions and bookings of the
    source beside those of staging, and the verdict with the number of lines that differ."""
    lines = [source_report(t, S.PRIMARY_KEY[t], sources[t], raw[t], start, end) for t in sources]
    count = lambda df: df.agg(F.count("*").alias("n"))
    # Fixed labels of the report.
    lines += [
        closing_line("doubles soumissions", repeated_tuples(sources["payments"]), stg_payments.agg(
            F.count_if("is_duplicate_submission").alias("n"))),
        closing_line("réservations", count(sources["bookings"]), count(stg_bookings))]
    report = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lines)
    failed = F.count_if(~F.col("conforme"))
    verdict = report.agg(failed.cast("long").alias("n")).select(
        F.when(F.col("n") == 0, "RÉCONCILIATION CONFORME").otherwise(
            F.concat(F.col("n").cast("string"), F.lit(" ÉCART(S) À EXPLIQUER"))).alias("t"),
        (F.col("n") == 0).alias("conforme"))
    return report.unionByName(verdict, allowMissingColumns=True)
