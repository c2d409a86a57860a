"""Compare a registered query with its oracle in DuckDB."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, Decimal):
        return f"D{v}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, build, sql, sf_dir) -> dict:
    df = build(spark, sf_dir)
    spark_rows = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    duck_rows = rows_of(columns, cur.fetchall())
    types = dict(zip(columns, (str(d[1]) for d in cur.description)))
    wrong = {
        n: (t, types.get(n)) for n, t in df.dtypes
        if KINDS.get(t, t.upper().replace("DECIMAL", "DECIMAL")) != str(types.get(n)).replace(" ", "")}
    return {
        "columns": sorted(df.columns) == sorted(columns), "types": wrong,
        "rows": (len(spark_rows), len(duck_rows)), "equal": spark_rows == duck_rows,
        "sample": [
            next((r for r in spark_rows if r not in set(duck_rows)), None),
            next((r for r in duck_rows if r not in set(spark_rows)), None)]
        if spark_rows != duck_rows else None,
    }
