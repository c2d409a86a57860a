"""Column expressions for cleaning, keys, flags and row images."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed labels of the lead-time report; a NULL lead time takes the last one.
LEAD_TIME_LABELS = ["0. incohérent", "1. 0-7 j", "2. 8-30 j", "3. 31-90 j", "4. > 90 j"]


def clean_currency(c: Column) -> Column:
    return F.upper(F.trim(c))


def clean_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def surrogate_key(*parts: Column) -> Column:
    """Hex MD5 of the parts as text, joined by a pipe."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def lead_time_bucket(days: Column) -> Column:
    bucket = F.when(days < 0, LEAD_TIME_LABELS[0])
    for upper, label in zip((7, 30, 90), LEAD_TIME_LABELS[1:]):
        bucket = bucket.when(days <= upper, label)
    return bucket.otherwise(LEAD_TIME_LABELS[-1])


def row_image(op: Column, before: Column, after: Column) -> Column:
    """The image that describes the row: what was deleted, else what is now.

    Chosen by the operation, never by coalesce: a JSON null is not a SQL NULL.
    """
    return F.when(op == "d", before).otherwise(after)


def measured_text(c: Column) -> Column:
    """Text of a value after its length, for fingerprints: no two rows of values give
    the same text side by side, and NULL differs from every text."""
    text = c.cast("string")
    return F.coalesce(
        F.concat(F.lit("V"), F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N"))
