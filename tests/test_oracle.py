"""Every registered query equals its SQL: columns, types, rows and values."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from catalog.registry import ORACLE, QUERIES
from harness import compare, connect


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(name, spark, duck, sf):
    result = compare(spark, duck, QUERIES[name], ORACLE[name], sf)
    assert result["columns"] and not result["types"], result
    assert result["equal"], result


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()


def test_entry_has_a_row_per_tier(spark):
    assert {r.tier for r in entry.entry(spark).collect()} == {"standard", "silver", "gold"}
