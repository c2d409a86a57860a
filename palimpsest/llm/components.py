"""Connected components of a link table, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over the links (a, b), for every id in a link.

    Each round takes the smallest label among the neighbours (a partial aggregate,
    so a hub with many links is pre-aggregated), then jumps to the label of that
    label; a chain of n links needs about log n rounds.
    """
    both = stored(links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(
        links.select("b", "a")), "links")
    labels = stored(both.groupBy("id").agg(
        F.least(F.col("id"), F.min("other")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), "comp"), "other").groupBy(
            "id").agg(F.min("comp").alias("near"))
        moved = labels.join(near, "id").select(
            "id", F.col("comp").alias("old"), F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("beyond"))
        after = stored(moved.join(jump, "next", "left").select(
            "id", "old", F.least("next", "beyond").alias("comp")), "labels")
        if after.filter("comp != old").isEmpty():
            return after.select("id", "comp")
        labels = after.select("id", "comp")
