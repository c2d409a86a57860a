"""Registered queries: a DataFrame builder and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.frames import Frames
from catalog.oracle_tables import sql as with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, needs: str = ""):
    """Register a builder ``f(frames) -> DataFrame`` under ``name``.

    ``sql`` is the oracle; ``needs`` names the derived tables it reads.
    """
    def add(build: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Frames(spark, sf_dir))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_tables(sql, *needs.split())
        return build

    return add
