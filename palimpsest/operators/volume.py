"""Volume floor and spike detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def below_floor(df: DataFrame, floor: int) -> DataFrame:
    """One row when the table has fewer rows than ``floor``, else none."""
    return df.agg(F.count("*").alias("lignes")).select(
        "lignes", F.lit(floor).cast("bigint").alias("plancher")).where("lignes < plancher")


def daily_volume(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.col(day).alias("jour")).agg(F.count("*").alias("n"))


def volume_spikes(
    daily: DataFrame, *, window: int = 14, needed: int = 7, factor: float = 4,
) -> DataFrame:
    """Active days above ``factor`` times the median of the previous active days.

    The window has no partition key, which is safe after the daily aggregate:
    its input is one row per calendar day.
    """
    previous = Window.orderBy("jour").rowsBetween(-window, -1)
    rated = daily.withColumns({
        "nb_ref": F.count("n").over(previous),
        "mediane": F.percentile("n", F.lit(0.5)).over(previous),
    })
    return rated.where((F.col("nb_ref") >= needed) & (F.col("n") > factor * F.col("mediane"))) \
        .select("jour", "n", "mediane", F.round(F.col("n") / F.col("mediane"), 1).alias("facteur"))
