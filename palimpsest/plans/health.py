"""Pipeline health over the event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import schemas as S
from palimpsest.functions import classify_incident, whole_hours_between

MESSAGE_LIMIT = 500  # fixed value: longest stored exception message


def shape_events(attempts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pipeline events from task attempts."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    return attempts.select(
        *keep,
        F.date_format("observed_at", iso).alias("horodatage"), "evenement", "dag_id", "task_id",
        "run_id", F.date_format("logical_date", iso).alias("logical_date"),
        "tentative", "retries", "relances_max",
        F.round("duration_s", 1).alias("duree_tentative_s"), "exception_type",
        F.substring("exception_message", 1, MESSAGE_LIMIT).alias("exception_message"),
        classify_incident(F.col("exception_type"), F.col("exception_message"))
        .alias("scenario_runbook"))


def typed_events(parsed: DataFrame) -> DataFrame:
    """Instants as timestamps; NULL where the text is not a valid one."""
    return parsed.withColumns({
        "horodatage": F.col("horodatage").try_cast("timestamp"),
        "logical_date": F.col("logical_date").try_cast("timestamp")})


def parse_lines(lines: DataFrame) -> DataFrame:
    """JSON text lines to typed events; unknown fields are ignored and a line
    that is broken or has no valid instant is marked, not dropped (S11)."""
    schema = T.StructType(S.PIPELINE_EVENT.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = lines.select(F.from_json("value", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("e")).select("e.*")
    return typed_events(parsed).withColumn(
        "rejected", F.col("_corrupt").isNotNull() | F.col("horodatage").isNull()).drop("_corrupt")


def in_window(events: DataFrame, start: str, end: str) -> DataFrame:
    c = F.col("horodatage")
    return events.where(
        (c >= F.lit(start).cast("timestamp")) & (c < F.lit(end).cast("timestamp")))


def dead_pipelines(events: DataFrame, as_of: str, hours: int = 26) -> DataFrame:
    """No success for more than ``hours`` whole hours."""
    last = events.where("evenement = 'succes'").groupBy("dag_id").agg(
        F.max("horodatage").alias("dernier_succes"))
    age = whole_hours_between(F.col("dernier_succes"), F.lit(as_of).cast("timestamp"))
    return last.withColumn("heures", age).where(F.col("heures") > hours)


def slow_tasks(events: DataFrame, as_of: str, days: int = 14, factor: float = 2) -> DataFrame:
    """Successes above ``factor`` times the median of their task.

    The median is an approximate percentile: its partial state is bounded, so a
    task with most of the rows is still reduced before the exchange.
    """
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    done = events.where((F.col("evenement") == "succes") & (F.col("horodatage") >= since)).select(
        "dag_id", "task_id", "horodatage", "duree_tentative_s")
    median = done.groupBy("dag_id", "task_id").agg(
        F.percentile_approx("duree_tentative_s", 0.5, 10000).alias("med_s"))
    return done.join(median, ["dag_id", "task_id"]).where(
        F.col("duree_tentative_s") > factor * F.col("med_s")).orderBy(
        F.desc("duree_tentative_s"), "dag_id", "task_id", "horodatage")


def uncovered_incidents(events: DataFrame) -> DataFrame:
    """Incidents that no run-book scenario covers."""
    return (
        events.where(F.col("evenement").isin("echec", "relance")
                     & F.col("scenario_runbook").isNull())
        .groupBy("exception_type", "exception_message")
        .agg(F.count("*").alias("n"), F.max("horodatage").alias("dernier"))
        .orderBy(F.desc("n"), "exception_type", "exception_message"))


def detection_latency(events: DataFrame) -> DataFrame:
    """Start of the first failed attempt to the final failure, per task run."""
    begun = F.col("horodatage") - F.make_dt_interval(secs=F.col("duree_tentative_s"))
    spans = events.groupBy("run_id", "task_id").agg(
        F.min(F.when(F.col("evenement") == "relance", F.struct("horodatage", begun.alias("begun"))))
        .alias("first_retry"),
        F.max(F.when(F.col("evenement") == "echec", F.col("horodatage"))).alias("failed_at"))
    begun_at = F.col("first_retry.begun")
    return (
        spans.where(F.col("first_retry").isNotNull() & F.col("failed_at").isNotNull())
        .select(
            "run_id", "task_id", begun_at.alias("started_at"), "failed_at",
            (F.unix_micros("failed_at") - F.unix_micros(begun_at)).alias("latency_us")))


def expiring_partitions(
    inventory: DataFrame, as_of: str, within: int = 7, retention: int = S.RETENTION_DAYS,
) -> DataFrame:
    """Partitions that expire within ``within`` days.

    ``inventory`` has table_name, partition_id (text) and total_rows; ids that
    are not a real day are left out.
    """
    expires = F.date_add(F.to_date("partition_id", "yyyyMMdd"), retention)
    today = F.lit(as_of).cast("date")
    real = F.col("partition_id").rlike(r"^\d{8}$")
    return (
        inventory.where(real).withColumn("expire_le", expires)
        .where(F.col("expire_le") <= F.date_add(today, within))
        .select("table_name", "partition_id", "expire_le",
                F.datediff("expire_le", today).alias("jours_restants"), "total_rows")
        .orderBy("expire_le", "table_name"))


def first_expiry(inventory: DataFrame, retention: int = S.RETENTION_DAYS) -> DataFrame:
    """First partition of each table, their number and when the first expires."""
    real = ~F.col("partition_id").isin("__NULL__", "__UNPARTITIONED__")
    return inventory.where(real).groupBy("table_name").agg(
        F.min("partition_id").alias("premiere_partition"), F.count("*").alias("partitions"),
    ).withColumn(
        "expire_vers", F.date_add(F.to_date("premiere_partition", "yyyyMMdd"), retention))
