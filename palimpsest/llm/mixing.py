"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree (by default domain, language, source). Every
node shares its budget among its children by weight; a child that has less text
than its share leaves the shortage to its siblings first, and only what a whole
branch cannot fill goes up to the siblings of its ancestors. A leaf then takes a
prefix of its tokens from seeded epochs: whole passes over its documents, and of
the last pass the documents up to the budget.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD, stored

# A leaf's order is cut into 16**BUCKET_DIGITS hash ranges: only the range that
# holds the end of the prefix is ordered row by row.
BUCKET_DIGITS = 4
LEAF = ["__domain", "__lang", "__source"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Share ``budget`` of each parent among its nodes (``cap``, ``weight``) as ``given``.

    The classic water level: nodes in order of cap / weight fill up while the
    level of those that remain is above them; the others get level x weight.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    marked = nodes.withColumn("level", level).withColumn(
        "full", F.col("cap") <= F.col("level") * F.col("weight"))
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    return marked.withColumn("given", F.when(
        F.col("full"), F.col("cap").cast("double")).otherwise(rest * F.col("weight"))
    ).drop("level", "full", "budget")


def weight_of(value: Column, weights: dict[str, int]) -> Column:
    """A whole, positive weight for every value; 1 unless named."""
    if any(int(w) != w or w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of at least 1")
    return reduce(lambda c, kv: F.when(value == kv[0], kv[1]).otherwise(c),
                  weights.items(), F.lit(1)).cast("long")


def leaf_budgets(
    leaves: DataFrame, budget: Column, weights: dict[str, dict[str, int]], epochs: int,
) -> DataFrame:
    """``leaves`` (LEAF, tokens) with ``given``, the tokens that each may take."""
    caps = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = caps.agg(F.least(F.sum("cap"), budget).cast("double").alias("budget"))
    nodes = None
    for depth, name in enumerate(LEAF):
        path = LEAF[:depth + 1]
        level = caps.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn(
            "weight", weight_of(F.col(name), weights.get(name.strip("_"), {})))
        if nodes is None:
            level = level.join(F.broadcast(total))  # one row
            nodes = share_out(level, [F.lit(0)], name)
        else:
            above = nodes.select(*LEAF[:depth], F.col("given").alias("budget"))
            nodes = share_out(level.join(above, LEAF[:depth]), LEAF[:depth], name)
    return nodes.select(*LEAF, "given").join(leaves, LEAF)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens`` (words) and ``copies``, the times it is taken;
    columns of these names are replaced. See ``placed`` for the rest."""
    spare = [f"row.`{c}`" for c in docs.columns if c.lower() not in ("n_tokens", "copies")]
    return placed(docs, **how).select(*spare, "n_tokens", "copies")


def taken(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that ``placed`` takes at least once, with all of their columns."""
    return placed(docs, **how).filter("copies > 0").select("row.*")


def placed(
    docs: DataFrame, *, budget: Column, weights: dict[str, dict[str, int]], domain: Column,
    epochs: int = 1, seed: int = 0, text: str = "text",
) -> DataFrame:
    """(row, n_tokens, copies): every row of ``docs`` as a struct, its words, the times it is taken.

    ``budget`` is a whole number of tokens; it may use ``F.sum("cap")``, the tokens
    at hand times ``epochs``. A null domain, language or source is the branch
    named "". Texts without words weigh nothing and are taken when the prefix
    passes them. Ties in the seeded order fall to the id, and equal rows are
    interchangeable. An empty table gives no rows. No name of the input's columns can
    meet one of the plan's.
    """
    value = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    named = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", value(domain).alias("__domain"),
        value(F.col("lang")).alias("__lang"), value(F.col("source")).alias("__source"),
        n_words(F.col(text)).alias("n_tokens"))
    sized = stored(named.select("doc_id", *LEAF, "n_tokens"), "mix-sizes")
    leaves = sized.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    given = stored(leaf_budgets(leaves, budget, weights, epochs), "mix-budgets").withColumn(
        "whole", F.when(F.col("tokens") > 0, F.floor(F.col("given") / F.col("tokens"))).otherwise(0)
    ).withColumn("part", F.floor(F.col("given") - F.col("whole") * F.col("tokens")))
    plan = given.select(*LEAF, "whole", "part")

    def ordered(df: DataFrame) -> DataFrame:
        key = F.md5(F.concat_ws(
            ":", F.lit(str(seed)), F.col("whole").cast("string"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        return df.join(plan, LEAF).withColumn("__key", key).withColumn(
            "__bucket", F.substring("__key", 1, BUCKET_DIGITS))

    # Per leaf at most 16**BUCKET_DIGITS ranges: the one where the prefix ends.
    ranges = ordered(sized).groupBy(*LEAF, "part", "__bucket").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*LEAF).orderBy("__bucket"))
    edges = stored(
        ranges.withColumn("upto", upto).filter(F.col("upto") > F.col("part"))
        .groupBy(*LEAF).agg(F.min(F.struct("__bucket", F.col("upto") - F.col("n"))).alias("e"))
        .select(*LEAF, F.col("e.__bucket").alias("__edge"), F.col("e.col2").alias("__before")),
        "mix-edges")
    placed = ordered(named).join(edges, LEAF, "left")
    on_edge = F.coalesce(F.col("__bucket") == F.col("__edge"), F.lit(False))
    inside = F.coalesce(F.col("__bucket") < F.col("__edge"), F.lit(True)).cast("long")
    sure = placed.filter(~on_edge).withColumn("copies", F.col("whole") + inside)
    run = Window.partitionBy(*LEAF).orderBy("__key", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    last = placed.filter(on_edge).withColumn("copies", F.col("whole") + (
        F.col("__before") + F.sum("n_tokens").over(run) <= F.col("part")).cast("long"))
    return sure.unionByName(last).select("row", "n_tokens", F.col("copies").cast("long"))
