"""Partition inventory of a stored or derived table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_inventory(df: DataFrame, table: str, day: str = "_interval_start") -> DataFrame:
    """Rows per partition. On a stored table only file footers are read: the
    partition column is in the path and no data column is needed."""
    ident = F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("__NULL__"))
    return df.groupBy(ident.alias("partition_id")).agg(F.count("*").alias("total_rows")).select(
        F.lit(table).alias("table_name"), "partition_id", "total_rows")
