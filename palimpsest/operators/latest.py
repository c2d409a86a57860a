"""Latest row per key, and marking of repeated submissions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str | Column], *order: Column) -> DataFrame:
    """The first row of every key in ``order``, which should be total.

    ``row_number() = 1`` is planned as a group limit before the exchange as
    well as after it, so each input partition sends at most one row per key: a
    key that holds a third of the rows costs its reducer one row per mapper.
    Unlike an aggregate over a struct of all columns it keeps column pruning.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def flag_repeats(
    df: DataFrame, row_id: str, business_key: Sequence[str], instant: str,
    order: Sequence[str], flag: str, stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Flag all but the first row of each business key; NULL instants never repeat.

    A window over the business key would hold a whole group of copies in one
    task. The first row of each group is found with the group limit instead
    (bounded per mapper) and joined back on the unique row id, whose hash
    spreads any group over all tasks and is the partitioning that the caller's
    own dedup already has.

    ``stage`` may store the ids of the repeats, found from ids alone. As a table their size is
    known before the rows move: where they are few, the rows stay where they are.
    """
    firsts = (
        latest_by(
            df.where(F.col(instant).isNotNull())
            .select(row_id, *business_key, *[c for c in order if c != row_id]),
            list(business_key), *[F.asc(c) for c in order])
        .select(row_id, F.lit(True).alias("_first"))
    )
    if stage:
        repeats = df.where(F.col(instant).isNotNull() & F.col(row_id).isNotNull()).select(row_id).join(
            firsts, row_id, "left_anti").distinct()
        found = stage(repeats).withColumn("_repeats", F.lit(True))
        return df.join(found, row_id, "left").withColumn(
            flag, F.col(instant).isNotNull() & (F.col("_repeats").isNotNull() | F.col(row_id).isNull()),
        ).drop("_repeats")
    return (
        df.join(firsts, row_id, "left")
        .withColumn(flag, F.col(instant).isNotNull() & F.col("_first").isNull())
        .drop("_first")
    )
