"""Incident classification (P20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed signatures, first match wins: text searched in the lowercased
# "type message", then the run-book scenario it stands for.
SIGNATURES = [
    ("rate limits", "S2a"),
    ("quota exceeded", "S2b"),
    ("connectiontimeout", "S1b"),
    ("operationalerror", "S1"),
]


def classify_incident(kind: Column, message: Column) -> Column:
    """Scenario of an incident; NULL when there is none or none is known."""
    text = F.lower(F.concat_ws(" ", kind, message))
    tests = [F.when(F.contains(text, F.lit(s)), F.lit(name)) for s, name in SIGNATURES]
    return F.coalesce(*tests)
