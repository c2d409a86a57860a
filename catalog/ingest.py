"""Windowed ingestion.

Read-back queries write the derived rows through the ingestion functions into
a fresh folder and return what a reader then sees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from palimpsest.plans.reconcile import window_of
from palimpsest.sources import raw as I

AS_OF = "2002-01-01"
FIRST, LAST = "1998-01-01", "1998-03-31"
LOADED_AT = "2002-01-01 00:00:00"


def _table(t, entity: str, purpose: str) -> tuple[I.DayTable, str]:
    root = t.fresh_folder(purpose)
    name = f"{purpose}_{root[-12:]}"
    return I.raw_table(t.spark, entity, name, f"{root}/raw"), root


def _per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("_interval_start").agg(
        F.count("*").alias("n"), F.sum("total_amount").cast("decimal(20,2)").alias("amount"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled"))


PER_DAY = """
    SELECT CAST(updated_at AS DATE) AS _interval_start, count(*) AS n,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS amount,
           count(*) FILTER (WHERE status = 'cancelled') AS cancelled
    FROM {0} WHERE updated_at >= TIMESTAMP '1998-01-01' AND updated_at < TIMESTAMP '1998-04-01'
    {1} GROUP BY 1"""


@query("scan_window", """
    SELECT booking_id, customer_id, status, total_amount, updated_at FROM raw_bookings
    WHERE updated_at >= TIMESTAMP '1997-01-01' AND updated_at < TIMESTAMP '1997-04-01'""",
       "raw_bookings")
def _(t):
    """S1."""
    return I.scan_window(t.raw_bookings, "1997-01-01", "1997-04-01").select(
        "booking_id", "customer_id", "status", "total_amount", "updated_at")


@query("scan_orders_window", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def _(t):
    """S1 straight on a stored table: the bounds reach the Parquet scan."""
    from catalog.testdata import table

    orders = table(t.spark, t.sf_dir, "orders")
    lower, upper = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-04-01"))
    return orders.where((F.col("o_orderdate") >= lower) & (F.col("o_orderdate") < upper)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("assign_window", """
    SELECT CASE WHEN updated_at < TIMESTAMP '1996-01-01' THEN DATE '1995-12-31'
                ELSE CAST(updated_at AS DATE) END AS _interval_start, count(*) AS n
    FROM stg_bookings WHERE updated_at < TIMESTAMP '2000-01-01' GROUP BY 1""", "stg_bookings")
def _(t):
    """P18, P19."""
    closed = t.stg_bookings.where(F.col("updated_at") < F.lit("2000-01-01").cast("timestamp"))
    return closed.groupBy(
        window_of(F.col("updated_at"), "1996-01-01").alias("_interval_start")
    ).agg(F.count("*").alias("n"))


@query("snapshot_split", """
    SELECT CASE WHEN updated_at < TIMESTAMP '1996-01-01' THEN 'snapshot' ELSE 'windows' END AS part,
           count(*) AS n, min(updated_at) AS first_update, max(updated_at) AS last_update
    FROM stg_bookings GROUP BY 1""", "stg_bookings")
def _(t):
    """Snapshot and windows share no row and miss none."""
    split = lambda df, part: df.agg(
        F.count("*").alias("n"), F.min("updated_at").alias("first_update"),
        F.max("updated_at").alias("last_update")).select(F.lit(part).alias("part"), "*")
    return split(I.scan_window(t.stg_bookings, I.EPOCH, "1996-01-01"), "snapshot").unionByName(
        split(I.scan_window(t.stg_bookings, "1996-01-01", "9999-01-01"), "windows"))


@query("lineage_columns", """
    SELECT customer_id, updated_at, TIMESTAMP '2002-01-01' AS _ingested_at,
           'customer.parquet' AS _source_file, DATE '1994-06-04' AS _interval_start
    FROM raw_customers WHERE CAST(updated_at AS DATE) = DATE '1994-06-04'""", "raw_customers")
def _(t):
    """P1."""
    day = I.scan_window(t.raw_customers, "1994-06-04", "1994-06-05").select(
        "customer_id", "updated_at")
    return I.add_lineage(day, "1994-06-04", LOADED_AT).withColumn(
        "_source_file", F.regexp_extract("_source_file", "([^/]+)$", 1))


@query("batch_gate", """
    SELECT count(*) AS "rows", count(*) FILTER (WHERE booking_id IS NULL) AS null_keys,
           CAST(count(booking_id) - count(DISTINCT booking_id) AS BIGINT) AS repeated_keys,
           count(*) FILTER (WHERE updated_at < TIMESTAMP '1998-01-02'
                            OR updated_at >= TIMESTAMP '1998-01-09') AS outside_window,
           min(updated_at) AS first_update, max(updated_at) AS last_update
    FROM raw_bookings WHERE updated_at >= TIMESTAMP '1998-01-01'
      AND updated_at < TIMESTAMP '1998-01-08'""", "raw_bookings")
def _(t):
    """A batch with repeated keys and rows outside the stated window."""
    batch = I.scan_window(t.raw_bookings, "1998-01-01", "1998-01-08")
    return I.gate(batch, "booking_id", "1998-01-02", "1998-01-09")


ENTITIES = ["hotels", "customers", "bookings", "payments"]


@query("extract_complete", " UNION ALL ".join(
    f"SELECT '{e}' AS t, count(*) AS source, count(*) AS landed FROM raw_{e}" for e in ENTITIES),
    " ".join(f"raw_{e}" for e in ENTITIES))
def _(t):
    """All rows of every table, landed twice, are exactly those of the source."""
    root, out = t.fresh_folder("landing"), []
    for name in ENTITIES:
        source = getattr(t, f"raw_{name}")
        window = I.scan_window(source, I.EPOCH, AS_OF)
        path = I.landing_path(root, name, AS_OF)
        I.land(window, path)
        I.land(window, path)
        both = window.select(F.lit(False).alias("landed")).unionByName(
            I.read_landed(t.spark, [path], source.schema).select(F.lit(True).alias("landed")))
        out.append(both.agg(
            F.count_if(~F.col("landed")).alias("source"), F.count_if("landed").alias("landed")
        ).select(F.lit(name).alias("t"), "source", "landed"))
    return reduce(DataFrame.unionByName, out)


@query("ingest_window", """
    SELECT booking_id, status, total_amount, DATE '1998-02-10' AS _interval_start,
           TIMESTAMP '2002-01-01' AS _ingested_at, TRUE AS from_landing
    FROM stg_bookings WHERE CAST(updated_at AS DATE) = DATE '1998-02-10'""", "stg_bookings")
def _(t):
    """G1: extract, land, validate, load one day."""
    table, root = _table(t, "bookings", "ingest")
    I.ingest_window(t.stg_bookings, "bookings", table, f"{root}/landing", "1998-02-10", AS_OF,
                    ingested_at=LOADED_AT)
    return table.read().select(
        "booking_id", "status", "total_amount", "_interval_start", "_ingested_at",
        F.endswith("_source_file", F.lit("/bookings/dt=1998-02-10")).alias("from_landing"))


@query("partition_overwrite", PER_DAY.format("""(
    SELECT * REPLACE (CASE WHEN CAST(updated_at AS DATE) = DATE '1998-02-10' THEN 'cancelled'
                      ELSE status END AS status) FROM stg_bookings)""", ""), "stg_bookings")
def _(t):
    """A quarter loaded in one job, then one day replaced."""
    table, root = _table(t, "bookings", "overwrite")
    I.backfill(t.stg_bookings, "bookings", table, f"{root}/landing", FIRST, LAST, AS_OF,
               ingested_at=LOADED_AT)
    changed = t.stg_bookings.withColumn("status", F.lit("cancelled"))
    I.ingest_window(changed, "bookings", table, f"{root}/landing", "1998-02-10", AS_OF)
    return _per_day(table.read())


@query("replay_twice", PER_DAY.format("stg_bookings", ""), "stg_bookings")
def _(t):
    """Loaded without its late rows, then replayed with them, twice."""
    table, root = _table(t, "bookings", "replay")
    early = t.stg_bookings.where("booking_id % 5 <> 0")
    for source in (early, t.stg_bookings, t.stg_bookings):
        I.backfill(source, "bookings", table, f"{root}/landing", FIRST, LAST, AS_OF,
                   ingested_at=LOADED_AT)
    return _per_day(table.read())


@query("empty_window_clear", PER_DAY.format(
    "stg_bookings", "AND CAST(updated_at AS DATE) NOT IN (DATE '1998-01-20', DATE '1998-02-20')"),
    "stg_bookings")
def _(t):
    """Emptied days are cleared one by one and by a backfill, and
    kept where the policy says so."""
    table, root = _table(t, "bookings", "clear")
    load = lambda df: I.backfill(
        df, "bookings", table, f"{root}/landing", FIRST, LAST, AS_OF, ingested_at=LOADED_AT)
    load(t.stg_bookings)
    load(t.stg_bookings.where(F.to_date("updated_at") != F.lit("1998-01-20").cast("date")))
    nothing = t.stg_bookings.limit(0)
    for day, policy in [("1998-02-20", "clear"), ("1998-03-20", "keep")]:
        I.ingest_window(
            nothing, "bookings", table, f"{root}/landing", day, AS_OF, on_empty=policy)
    return _per_day(table.read())


@query("schema_union", """
    SELECT booking_id, updated_at, CASE WHEN updated_at >= TIMESTAMP '1998-01-06'
           THEN currency END AS currency
    FROM stg_bookings WHERE updated_at >= TIMESTAMP '1998-01-05'
      AND updated_at < TIMESTAMP '1998-01-07'""", "stg_bookings")
def _(t):
    """Landed files of which one lacks a column."""
    root = t.fresh_folder("union")
    paths = [I.landing_path(root, "bookings", d) for d in ("1998-01-05", "1998-01-06")]
    source = t.stg_bookings.select("booking_id", "updated_at", "currency")
    I.land(I.scan_window(source.drop("currency"), "1998-01-05", "1998-01-06"), paths[0])
    I.land(I.scan_window(source, "1998-01-06", "1998-01-07"), paths[1])
    return I.read_landed(t.spark, paths)


@query("schema_evolution", """
    SELECT booking_id, CASE WHEN updated_at >= TIMESTAMP '1998-01-06' THEN 'web' END AS channel,
           CAST(updated_at AS DATE) AS _interval_start
    FROM stg_bookings WHERE updated_at >= TIMESTAMP '1998-01-05'
      AND updated_at < TIMESTAMP '1998-01-07'""", "stg_bookings")
def _(t):
    """The second day brings a new column."""
    table, root = _table(t, "bookings", "evolve")
    later = t.stg_bookings.withColumn("channel", F.lit("web"))
    for source, day in [(t.stg_bookings, "1998-01-05"), (later, "1998-01-06")]:
        I.ingest_window(source, "bookings", table, f"{root}/landing", day, AS_OF)
    return table.read().select("booking_id", "channel", "_interval_start")


@query("bootstrap", """
    SELECT CASE WHEN updated_at < TIMESTAMP '1998-01-01' THEN DATE '1997-12-31'
                ELSE CAST(updated_at AS DATE) END AS _interval_start, count(*) AS n,
           CAST(sum(total_amount) AS DECIMAL(20,2)) AS amount,
           count(*) FILTER (WHERE status = 'cancelled') AS cancelled
    FROM stg_bookings WHERE updated_at < TIMESTAMP '1998-04-01' GROUP BY 1""", "stg_bookings")
def _(t):
    """The snapshot once (the second call refuses), then the windows."""
    table, root = _table(t, "bookings", "bootstrap")
    for _ in range(2):
        I.snapshot(
            t.stg_bookings, "bookings", table, f"{root}/landing", FIRST, ingested_at=LOADED_AT)
    I.backfill(t.stg_bookings, "bookings", table, f"{root}/landing", FIRST, LAST, AS_OF,
               ingested_at=LOADED_AT)
    return _per_day(table.read())


