"""Line-first quality rules, in column expressions only.

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines go, and a document that loses too much of its text goes as a whole. All
work is inside a row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD

# Fixed values of the rules.
SYMBOLS = "[^#*$%&|<>]+"  # all but the counted symbols
PUNCTUATION = "[.,;:!?…。]"
SEPARATORS = "[^|»›•·]+"  # all but separators of menus
MENU = "^[^\\p{L}]*(home|menu|search|log ?in|sign ?in|sign ?up|next|previous|back|share|contact|contact us|about|about us|skip to content)[^\\p{L}]*$"
BOILERPLATE = "all rights reserved|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|subscribe now|click here|licensed under|under the [a-z ]*license|copyright|©"
MIN_WORDS, MAX_REPEATED = 50, 50  # base rule: words, per cent of repeated words
MAX_SYMBOLS, BOILERPLATE_CHARS, KEPT = 8, 200, 50  # per cent, characters, per cent
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
NEW = [*BASE, "base_failed", "kept_chars", "line_chars", "kept"]


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, first occurrences included."""
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) >= 4, hashed).otherwise(F.array().cast("array<bigint>"))


def covered(ranked: Column) -> Column:
    """Words covered by the windows whose hash has an equal neighbour in ``ranked``."""
    same = F.filter(ranked, lambda x, i: (
        (i > 0) & (ranked[F.greatest(i - 1, F.lit(0))]["k"] == x["k"])) | (
        (i < F.size(ranked) - 1) & (
            ranked[F.least(i + 1, F.size(ranked) - 1)]["k"] == x["k"])))
    return F.size(F.array_distinct(F.flatten(F.transform(
        same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def line_passes(line: Column) -> Column:
    low, chars = F.lower(line), F.char_length(line)
    symbols = F.char_length(F.regexp_replace(line, SYMBOLS, "")) + chars - F.char_length(
        F.replace(line, F.lit("!!"), F.lit("")))
    menus = F.char_length(F.regexp_replace(line, SEPARATORS, ""))
    punctuation = line.rlike(PUNCTUATION) & (symbols * 100 <= chars * MAX_SYMBOLS)
    navigation = ((menus >= 3) & (menus * 40 >= chars)) | low.rlike(MENU)
    boilerplate = (chars <= BOILERPLATE_CHARS) & low.rlike(BOILERPLATE)
    return punctuation & ~navigation & ~boilerplate


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its word counts, the base rule and the verdict ``kept``.

    Also ``clean_text``: the passing lines, repeats of a line once, or the text as
    it is if no line fails. A null or empty text has counts of 0 and fails the
    base rule. Repeated rows are judged alike. Other columns pass through;
    columns named like the new ones are replaced. An empty table gives no rows.
    """
    made = {n.lower() for n in [*NEW, "clean_text"]}
    rows = docs.select(*(c for c in docs.columns if c.lower() not in made))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = rows.withColumns({
        "__words": F.regexp_extract_all(body, F.lit(WORD), F.lit(0)),
        "__lines": F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))})
    rows = rows.withColumns({
        "__windows": repeated_words(F.col("__words")),
        "__kept": F.array_distinct(F.filter("__lines", line_passes))})
    rows = rows.withColumn("__ranked", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"), F.array_sort(F.transform(
            "__windows", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))))
    chars = lambda c: F.char_length(F.array_join(c, "")).cast("long")
    rows = rows.withColumns({
        "n_words": F.size("__words").cast("long"), "word_chars": chars("__words"),
        "n_symbols": F.char_length(F.regexp_replace(body, SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("__ranked").isNull(), 0).otherwise(
            covered(F.col("__ranked"))).cast("long"),
        "kept_chars": chars("__kept"), "line_chars": chars("__lines")})
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    clean = F.when(F.size("__kept") == F.size("__lines"), F.col(text)).otherwise(
        F.array_join("__kept", "\n"))
    # __row keeps a later filter on the verdict from being copied below the projections,
    # which would evaluate all of the above once more for every use of a column
    return rows.withColumns({
        "__row": F.monotonically_increasing_id(),
        "kept": ~F.col("base_failed") & (100 * F.col("kept_chars") >= KEPT * F.col("line_chars")),
        "clean_text": clean}).drop("__words", "__lines", "__windows", "__kept", "__ranked")


def cleaned(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that stay, with their failing lines removed, in the columns of ``docs``."""
    seen = judged(docs.select(*(
        F.col(c).alias(f"__in_{c}") if c != text else F.col(c) for c in docs.columns)), text)
    changed = F.coalesce(F.col("clean_text") != F.col(text), F.lit(False))
    return seen.filter(F.col("kept") & (F.col("__row") >= 0)).select(*(
        F.col("clean_text").alias(c) if c == text else
        F.when(changed, F.char_length("clean_text")).otherwise(F.col(f"__in_{c}")).cast(
            docs.schema[c].dataType).alias(c) if c == n_chars else F.col(f"__in_{c}").alias(c)
        for c in docs.columns))
