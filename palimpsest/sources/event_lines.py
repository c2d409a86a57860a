"""Pipeline event log on disk: JSON lines in, a daily metrics table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import schemas as S
from palimpsest.plans.health import in_window, parse_lines, typed_events
from palimpsest.sources.raw import DayTable, require_closed_day

METRICS = T.StructType([
    T.StructField(f.name, T.TimestampType() if f.name in ("horodatage", "logical_date")
                  else f.dataType) for f in S.PIPELINE_EVENT
] + [T.StructField("_charge_le", T.TimestampType())])


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Every line as an event, with ``rejected`` set on unusable ones."""
    return parse_lines(spark.read.text(path))


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """The same scan, failing on the first broken line."""
    return typed_events(
        spark.read.schema(S.PIPELINE_EVENT).option("mode", "FAILFAST").json(path))


def load_day(
    spark: SparkSession, path: str, metrics: DayTable, day: str, as_of: str,
    loaded_at: str, strict: bool = False,
) -> tuple[int, int]:
    """Replace one day of the metrics table (S13); an empty day is cleared, or
    a replay would leave stale rows behind. Returns the rows of the day and the
    lines of the log that were rejected (S11)."""
    start, end = require_closed_day(day, as_of)
    if strict:
        events, rejected = read_strict(spark, path), 0
    else:
        lines = read_tolerant(spark, path)
        rejected = lines.where("rejected").count()
        events = lines.where("NOT rejected").drop("rejected")
    rows = in_window(events, start, end).withColumn(
        "_charge_le", F.lit(loaded_at).cast("timestamp"))
    metrics.replace_day(rows, day)
    return metrics.rows_on(day).count(), rejected
