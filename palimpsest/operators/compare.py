"""Comparisons between two sides: ids, counts, values, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import epoch_seconds, measured_text


def id_difference(
    left: DataFrame, right: DataFrame, key: str, only_left: str, only_right: str,
    label: str = "ecart",
) -> DataFrame:
    """Ids present on one side only, labelled by side.

    Both sides are tagged and grouped once, so each is read and exchanged once
    and repeated ids collapse before the exchange; two anti joins would read
    both sides twice.
    """
    sides = left.select(key, F.lit(True).alias("_left")).unionByName(
        right.select(key, F.lit(False).alias("_left")))
    found = sides.groupBy(key).agg(
        F.bool_or("_left").alias("_l"), F.bool_or(~F.col("_left")).alias("_r"))
    return found.where(F.col("_l") != F.col("_r")).select(
        F.when(F.col("_l"), only_left).otherwise(only_right).alias(label), key)


def first_ids(difference: DataFrame, key: str, label: str, n: int = 10) -> DataFrame:
    """Count per side and its ``n`` smallest ids, the report line of a
    reconciliation (O4).

    The ids are ranked per side with a group limit, so only ``n`` rows per
    mapper and side are exchanged; the counts are a partial aggregate.
    """
    rank = F.row_number().over(Window.partitionBy(label).orderBy(key))
    smallest = (
        difference.withColumn("_rank", rank).where(F.col("_rank") <= n)
        .groupBy(label).agg(F.array_sort(F.collect_list(key)).alias("_ids"))
        .select(label, F.concat_ws(",", "_ids").alias("first_ids")))
    return difference.groupBy(label).agg(F.count("*").alias("n")).join(smallest, label)


def count_difference(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts per key on both sides, 0 where a side has none (J11): the
    full outer compare as one grouped pass over the tagged union."""
    sides = source.select(*keys, F.lit(1).alias("_s")).unionByName(
        target.select(*keys, F.lit(0).alias("_s")))
    return sides.groupBy(*keys).agg(
        F.count_if(F.col("_s") == 1).alias("source"), F.count_if(F.col("_s") == 0).alias("cible"))


def interval_verdict(counts: DataFrame) -> DataFrame:
    """Reading of a per-interval reconciliation."""
    source, target = F.col("source"), F.col("cible")
    return counts.withColumn(
        "verdict",
        F.when((target == 0) & (source > 0), "anomalie: partition absente")
        .when(target < source, "anomalie: chargement partiel")
        .when(target > source, "derive normale")
        .otherwise("sain"))


def instant_drift(target: DataFrame, source: DataFrame, key: str, instant: str) -> DataFrame:
    """Distribution of target minus source instants in seconds, rounded to the
    millisecond; 'absent' where the key is unknown to the source (J12)."""
    s = source.select(F.col(key).alias("_key"), epoch_seconds(F.col(instant)).alias("_epoch"))
    shift = F.round(epoch_seconds(F.col(instant)) - F.col("_epoch"), 3)
    label = F.when(F.col("_key").isNull(), "absent").otherwise(
        shift.cast("decimal(20,3)").cast("string"))
    return (
        target.select(key, instant).join(s, F.col(key) == F.col("_key"), "left")
        .groupBy(label.alias("decalage")).agg(F.count("*").alias("n")))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and order-free content fingerprint of a table.

    Each row is hashed and the hashes are summed, so the fingerprint does not
    depend on row order or partitioning, counts repeated rows, and needs only
    one partial aggregate: no task ever sees the whole table as one string.
    """
    names = sorted(columns or df.columns)
    text = F.concat(*[measured_text(F.col(c)) for c in names])
    digest = F.md5(text)

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")

    sums = df.select(part(1).alias("a"), part(17).alias("b")).agg(
        F.count("*").alias("lignes"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select(
        "lignes",
        F.when(F.col("lignes") == 0, "vide")
        .otherwise(F.md5(F.concat_ws("|", F.col("a").cast("string"), F.col("b").cast("string"))))
        .alias("empreinte"))
