"""Data-quality operators: a check is a frame of failing rows or a count of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicated(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once (C1, A4): a partial aggregate."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def outside(column: str, values: Sequence) -> Column:
    """Value not among the accepted ones; NULL is not a violation."""
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def unmatched(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent and the rows that carry them.

    The child is grouped by the key before the join, so what is exchanged is
    one row per value and a hot value is one row.
    """
    values = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("fk")).agg(
        F.count("*").alias("n"))
    return values.join(parent.select(F.col(pk).alias("fk")), "fk", "left_anti")


def count_rules(df: DataFrame, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Failing rows per rule, all rules in one pass over the table.

    ``rules`` maps a check name to (severity, predicate of a failing row). The
    result has one row per rule: check, severity, failures.
    """
    names = list(rules)
    counts = df.agg(*[
        F.count_if(rules[name][1]).alias(f"r{i}") for i, name in enumerate(names)])
    lines = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(rules[name][0]).alias("severity"),
                 F.col(f"r{i}").alias("failures"))
        for i, name in enumerate(names)])
    return counts.select(F.inline(lines))


def count_failures(name: str, severity: str, failing: DataFrame) -> DataFrame:
    """The report line of a check whose failures are rows of ``failing``."""
    return failing.agg(F.count("*").alias("failures")).select(
        F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failures")


def with_status(report: DataFrame) -> DataFrame:
    """Severity policy (C14): a failing check ends in its own severity."""
    return report.withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def freshness(
    df: DataFrame, table: str, loaded_until: Column, as_of: str,
    warn_hours: int, error_hours: int,
) -> DataFrame:
    """Age of the newest data at ``as_of`` and its status.

    ``loaded_until`` is data time for batch tables, so that loading old days
    does not make a source look fresh.
    """
    age = F.timestamp_diff("SECOND", F.col("loaded_until"), F.lit(as_of).cast("timestamp"))
    return df.agg(F.max(loaded_until).alias("loaded_until")).select(
        F.lit(table).alias("source"), "loaded_until",
        F.floor(age / 3600).cast("bigint").alias("age_hours"),
        F.when(age > error_hours * 3600, "error").when(age > warn_hours * 3600, "warn")
        .otherwise("pass").alias("status"))
