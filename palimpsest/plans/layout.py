"""Storage layouts of the fact and the queries that compare them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import schemas as S
from palimpsest.functions import sunday_week_start

LAYOUTS = ("plain", "clustered", "partitioned")
PERIOD = "booking_period"


def write_layouts(
    facts: DataFrame, root: str, names: Sequence[str] = LAYOUTS, unit: str = "day",
) -> dict[str, str]:
    """Copies of the fact: as it comes, range-clustered by day and hotel, and
    also partitioned by period.

    The period is the booking day, or the first day of a coarser ``unit``
    where a day has too few rows to fill a file.

    Both ordered copies are range-partitioned on (day, hotel, booking): a day
    or hotel with a third of the rows spans several tasks, and a task holds few
    days, so partitioning by day does not scatter small files.
    """
    order = ["booking_date", "hotel_id", "booking_id"]
    paths = {name: f"{root}/{name}" for name in names}
    if "plain" in paths:
        # The fact's own plan runs once; the ordered copies start from this one.
        facts.write.mode("overwrite").parquet(paths["plain"])
        facts = facts.sparkSession.read.schema(facts.schema).parquet(paths["plain"])
    ranged = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    if "clustered" in paths:
        ranged.write.mode("overwrite").parquet(paths["clustered"])
    if "partitioned" in paths:
        period = F.to_date(F.date_trunc(unit, "booking_date"))
        ranged.withColumn(PERIOD, period).write.mode("overwrite").partitionBy(PERIOD).parquet(
            paths["partitioned"])
    return paths


def read_layout(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A copy with its known schema; the period of a partitioned copy is found
    from its folders."""
    fields = list(like.schema.fields)
    if path.endswith("/partitioned"):
        fields.append(T.StructField(PERIOD, T.DateType()))
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _within(facts: DataFrame, start: str, end: str | None = None, unit: str = "month") -> DataFrame:
    """Rows booked in [start, end]. On a partitioned copy the same bounds, cut
    to the coarsest unit in use, also select the folders to open."""
    def clip(df: DataFrame, column: str, lower: Column, upper: Column | None) -> DataFrame:
        df = df.where(F.col(column) >= lower)
        return df if upper is None else df.where(F.col(column) <= upper)

    a, b = F.lit(start).cast("date"), F.lit(end).cast("date") if end else None
    rows = clip(facts, "booking_date", a, b)
    if PERIOD in facts.columns:
        rows = clip(rows, PERIOD, F.to_date(F.date_trunc(unit, a)), b)
    return rows


def row_counts(copies: dict[str, DataFrame]) -> DataFrame:
    """Proof that the copies hold the same rows."""
    frames = [
        df.agg(F.count("*").alias("lignes")).select(F.lit(name).alias("copie"), "lignes")
        for name, df in copies.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def amount_by_hotel_since(facts: DataFrame, day: str) -> DataFrame:
    """A date window."""
    return _within(facts, day).groupBy("hotel_id").agg(
        F.sum("total_amount").cast(S.MONEY_SUM).alias("amount"))


def amount_by_day_of_hotel(facts: DataFrame, hotel_id: int) -> DataFrame:
    """R2: one hotel."""
    return facts.where(F.col("hotel_id") == hotel_id).groupBy("booking_date").agg(
        F.sum("total_amount").cast(S.MONEY_SUM).alias("amount"))


def amount_by_week(facts: DataFrame) -> DataFrame:
    """Full scan, weeks start on Sunday."""
    return facts.groupBy(sunday_week_start(F.col("booking_date")).alias("week")).agg(
        F.sum("total_amount").cast(S.MONEY_SUM).alias("amount"))


def bookings_between(facts: DataFrame, start: str, end: str) -> DataFrame:
    """Q1."""
    return _within(facts, start, end).agg(F.countDistinct("booking_id").alias("bookings"))


def bookings_of_hotel(facts: DataFrame, hotel_id: int) -> DataFrame:
    """Q2."""
    return facts.where(F.col("hotel_id") == hotel_id).agg(
        F.countDistinct("booking_id").alias("bookings"))


def customers_by_hotel_since(facts: DataFrame, day: str) -> DataFrame:
    """Q3."""
    return _within(facts, day).groupBy("hotel_id").agg(
        F.countDistinct("customer_id").alias("customers"))


def busiest_hotel(facts: DataFrame) -> DataFrame:
    """O3: the most frequent hotel, smallest id on a tie."""
    return facts.groupBy("hotel_id").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "hotel_id").limit(1)


def anchor(facts: DataFrame) -> DataFrame:
    """Newest day and some hotel, the smallest for a stable answer."""
    return facts.agg(F.max("booking_date").alias("fin"), F.min("hotel_id").alias("hotel"))
