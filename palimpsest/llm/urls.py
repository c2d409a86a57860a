"""URL filter: path rules first, then gradient-boosted trees on lexical features.

Everything is DataFrame expressions and MLlib's DataFrame API. The trees are fitted
on a bounded sample of labelled URLs; suffix statistics cover all labelled URLs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, stored

FEATURES = [
    "f_length", "f_host_length", "f_labels", "f_depth", "f_digits", "f_entropy", "f_parameters",
    "f_query_length", "f_fragment", "f_hyphens", "f_suffix_rate", "f_suffix_weight",
    "f_section_rate", "f_section_weight"]
SAMPLE = 20_000  # labelled URLs at most that the trees see
PRIOR_WEIGHT = 20  # pseudo-counts of the overall rate in a suffix's rate


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    has = F.instr(text, "://") > 0
    rest = F.when(has, F.expr("substring(__url, instr(__url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of ``(verdict, host/path)`` and its verdict; null if none fits.

    A rule fits its host and all subdomains where the path starts with its own.
    Rules of equal length: the longer host wins, then the text.
    """
    def fits(rule: str) -> Column:
        host, _, path = rule.partition("/")
        return ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & (
            F.col("path").startswith(f"/{path}"))

    ranked = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r[1]))
    none = F.lit(None).cast("string")
    pick = lambda value: reduce(
        lambda rest, r: F.when(fits(r[1]), value(r)).otherwise(rest), reversed(ranked), none)
    return pick(lambda r: r[1]), pick(lambda r: r[0])


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with __url, host, path) and its features, but for the suffix statistics."""
    url, n = F.col("__url"), F.char_length("__url")
    chars = F.split(F.col("__url"), "")
    count = lambda pattern: F.regexp_count(url, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    share = lambda c: (n - F.char_length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(
        F.filter(F.array_distinct(chars), lambda c: c != ""), F.lit(0.0),
        lambda total, c: total - share(c) * F.log2(share(c)))
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    labels = F.split("host", "\\.")
    return urls.withColumns({
        "f_length": n.cast("double"), "f_host_length": F.char_length("host").cast("double"),
        "f_labels": F.size(labels).cast("double"), "f_depth": F.size(parts).cast("double"),
        "f_digits": F.when(n > 0, count("[0-9]") / n).otherwise(0.0),
        "f_entropy": F.coalesce(entropy, F.lit(0.0)),
        "f_parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"),
        "f_query_length": F.char_length(query).cast("double"),
        "f_fragment": F.contains(url, F.lit("#")).cast("double"), "f_hyphens": count("-"),
        "__suffix": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "__section": F.coalesce(F.get(parts, F.lit(0)), F.lit(""))})


def statistics(labelled: DataFrame, key: str, name: str) -> DataFrame:
    """Smoothed share of blocked URLs and the log of their number, per value of ``key``."""
    overall = labelled.agg(F.avg("label").alias("all"))  # one row
    return labelled.groupBy(key).agg(
        F.sum("label").alias("bad"), F.count("*").alias("n")).join(F.broadcast(overall)).select(
        key, ((F.col("bad") + PRIOR_WEIGHT * F.col("all")) / (F.col("n") + PRIOR_WEIGHT)).alias(
            f"f_{name}_rate"), F.log1p("n").alias(f"f_{name}_weight"))


def judged_urls(
    urls: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]], *, url: str = "url",
    sample: int = SAMPLE, trees: int = 12, depth: int = 3, seed: int = 7,
) -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or block).

    ``labelled`` has (url, label), 1 to block. The rule decides if one fits, else the
    trees: block where they find it likelier than not. With labels of one kind only,
    that kind is the verdict; without any, allow. Null urls and those without ``://``
    have an empty host and path, meet no rule and are judged by their features.
    Repeated rows are judged alike. Other columns pass through, in a struct of their own
    until the end; columns named like the four new ones are replaced. An empty table gives no rows.
    """
    new = ("host", "path", "rule", "verdict")
    host, path = host_and_path("__url")
    shape = lambda df, source: lexical(df.withColumn(
        "__url", F.coalesce(F.col(source).cast("string"), F.lit(""))).withColumns(
        {"host": host, "path": path}))
    known = stored(shape(labelled.filter("label is not null").select(
        "url", F.col("label").cast("double").alias("label")), "url").drop("url"), "url-labels")
    rule, verdict = rule_of(rules)
    kept = [c for c in urls.columns if c.lower() not in new or c == url]
    rows = shape(urls.select(F.struct(*kept).alias("__row"), F.col(url).alias("__given")), "__given")
    rows = rows.withColumns({"rule": rule, "__ruled": verdict})
    kinds = [r.label for r in known.select("label").distinct().limit(3).collect()]
    if len(kinds) < 2:
        default = "block" if kinds == [1.0] else "allow"
        return rows.withColumn("verdict", F.coalesce("__ruled", F.lit(default))).select("__row.*", *new)
    stats = [(k, n, stored(statistics(known, k, n), f"url-{n}"))
             for k, n in (("__suffix", "suffix"), ("__section", "section"))]
    filled = {f: 0.0 for f in FEATURES}
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__features")

    def vectors(df: DataFrame) -> DataFrame:
        for key, _, table in stats:
            df = df.join(table, key, "left")
        return assembler.transform(df.fillna(filled))

    bounded = known.orderBy(F.xxhash64("__url"), "__url", "label").limit(sample)
    train = stored(vectors(bounded).select("__features", "label"), "url-sample")
    model = GBTClassifier(
        featuresCol="__features", labelCol="label", maxIter=trees, maxDepth=depth, seed=seed,
        stepSize=0.2, maxBins=32, predictionCol="__prediction").fit(train)
    scored = model.transform(vectors(rows))
    learned = F.when(F.col("__prediction") == 1.0, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("__ruled", learned)).select("__row.*", *new)
