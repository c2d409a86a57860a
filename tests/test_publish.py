"""Publishing a range of days as one step, landing from a source that moves, equal slices, mixed types."""

from __future__ import annotations

import datetime as dt
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from palimpsest.session import work_dir
from palimpsest.sources import raw as I
from palimpsest.sources import types as Y

AS_OF = "2002-01-01"
FIRST, LAST = "1998-01-05", "1998-01-08"


@pytest.fixture(scope="module")
def bookings(spark, frames):
    path = work_dir(spark, "source")
    window = I.scan_window(frames.stg_bookings, "1998-01-01", "1998-02-01")
    window.write.parquet(path)
    return spark.read.schema(window.schema).parquet(path)


@pytest.fixture
def table(spark):
    root = work_dir(spark, "tables")
    return I.raw_table(spark, "bookings", f"t_{uuid.uuid4().hex}", f"{root}/raw")


def dated(source, mark):
    """The days of the range, all rows marked; one day is left out of the second load."""
    rows = I.scan_window(source, FIRST, "1998-01-09").withColumn("status", F.lit(mark))
    return I.add_lineage(rows, FIRST).withColumn(I.DAY, F.to_date("updated_at"))


def marks(df):
    return {(str(r[0]), r[1]) for r in df.select(I.DAY, "status").distinct().collect()}


STEPS = ["written", "committed", "switched 1998-01-05", "switched 1998-01-07", "added", "dropped"]


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_leaves_the_old_days_or_the_new_ones(bookings, table, step):
    table.replace_days(dated(bookings, "old"), FIRST, LAST)
    old = marks(table.read())
    assert {d for d, _ in old} >= {"1998-01-05", "1998-01-06", "1998-01-07"}
    later = dated(bookings, "new").where(F.col(I.DAY) != F.lit("1998-01-06").cast("date"))
    new = marks(later)
    table.replace_day(later.limit(0), "1998-01-08")  # a day to be added
    old = {(d, m) for d, m in old if d != "1998-01-08"}

    def crash(done):
        if done == step:
            raise RuntimeError(step)

    with pytest.raises(RuntimeError, match=step):
        table.replace_days(later, FIRST, LAST, after=crash)
    assert marks(table.read()) == (old if step == "written" else new)
    table.replace_days(later, FIRST, LAST)
    assert marks(table.read()) == new
    table.vacuum()
    assert marks(table.read()) == new


def test_the_next_writer_finishes_an_earlier_commit(bookings, table):
    table.replace_days(dated(bookings, "old"), FIRST, LAST)

    def crash(done):
        if done == "committed":
            raise RuntimeError(done)

    with pytest.raises(RuntimeError):
        table.replace_days(dated(bookings, "new"), FIRST, LAST, after=crash)
    one_day = dated(bookings, "last").where(F.col(I.DAY) == F.lit("1998-01-07").cast("date"))
    table.replace_day(one_day, "1998-01-07")
    got = marks(table.read())
    assert {m for d, m in got if d == "1998-01-07"} == {"last"} and {
        m for d, m in got if d != "1998-01-07"} == {"new"}


def test_two_threads_load_two_days_of_one_table(bookings, table):
    table.replace_days(dated(bookings, "old"), FIRST, LAST)
    failed = []

    def load(day):
        try:
            table.replace_day(dated(bookings, day).where(F.col(I.DAY) == F.lit(day).cast("date")), day)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=load, args=(d,)) for d in ("1998-01-05", "1998-01-06", "1998-01-07")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = marks(table.read())
    assert not failed and all((d, d) in got for d in ("1998-01-05", "1998-01-06", "1998-01-07"))
    assert {m for d, m in got if d == "1998-01-08"} <= {"old"}


def test_no_session_setting_is_touched(spark, bookings, table):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    seen = []
    table.replace_days(dated(bookings, "x"), FIRST, LAST, after=lambda _: seen.append(
        spark.conf.get("spark.sql.sources.partitionOverwriteMode")))
    assert seen and set(seen) == {before}


def test_landing_reads_a_source_once_and_lists_what_it_wrote(spark, bookings):
    """A source that moves between two readings cannot empty a day that was landed."""
    path, root = work_dir(spark, "moving"), work_dir(spark, "landing")
    rows = bookings.withColumn("updated_at", F.lit("1998-01-05 10:00:00").cast("timestamp"))
    rows.write.parquet(path)
    readings = spark.sparkContext.accumulator(0)

    def moved(batches):
        readings.add(1)
        yield from batches

    source = spark.read.schema(rows.schema).parquet(path).coalesce(1).mapInArrow(moved, rows.schema)
    assert I.land_days(source, root, "1998-01-04", "1998-01-06") == ["1998-01-05"]
    assert spark.read.parquet(f"{root}/dt=1998-01-05").count() == rows.count() > 0
    assert readings.value == 1  # one job reads the source, and reads it once
    assert I.land_days(source.limit(0), root, "1998-01-05", "1998-01-06") == []
    assert I.Folder(spark, root).names() == []


def test_slices_follow_the_rows_not_the_clock(spark):
    """Nine rows in ten fall into one hour and a third of all into one instant."""
    start = dt.datetime(2026, 9, 1)
    rows = spark.range(30_000).select("id", F.when(
        F.col("id") % 3 == 0, F.lit(start + dt.timedelta(hours=7))).when(
        F.col("id") % 10 > 0, F.lit(start + dt.timedelta(hours=7)) + F.make_dt_interval(
            secs=F.pmod(F.xxhash64("id"), F.lit(3_600_000)) / 1000.0)).otherwise(
        F.lit(start) + F.make_dt_interval(secs=F.pmod(F.xxhash64("id"), F.lit(86_399)).cast("double"))).alias("updated_at"))
    cuts = I.equi_depth_cuts(rows, 24, "updated_at", "id")
    predicates = I.window_predicates("2026-09-01", "2026-09-02", cuts, "updated_at", "id")
    counts = rows.agg(*[F.count_if(F.expr(p)).alias(str(n)) for n, p in enumerate(predicates)]).first()
    assert sum(counts) == rows.count() and max(counts) <= 2 * sum(counts) / 24 and len(predicates) < 40
    assert I.equi_depth_cuts(rows.limit(0), 24, "updated_at", "id") == []
    assert len(I.window_predicates("2026-09-01", "2026-09-02", [])) == 1


def write(spark, root, name, sql):
    path = f"{root}/{name}"
    spark.sql(sql).write.parquet(path)
    return path


def test_int_beside_bigint_beside_a_missing_column(spark):
    root = work_dir(spark, "types")
    paths = [
        write(spark, root, "a", "SELECT 1 AS k, 5 AS n, DATE '2026-01-01' AS d, 1.5BD AS m, 2.5F AS f"),
        write(spark, root, "b", "SELECT 2L AS k, 5000000000L AS n, TIMESTAMP '2026-01-02 03:00:00' AS d, 12.25BD AS m"),
        write(spark, root, "c", "SELECT 3 AS k, 2.25D AS f, 'new' AS extra")]
    got = Y.read_reconciled(spark, paths)
    assert dict(got.dtypes) == {"k": "bigint", "n": "bigint", "d": "timestamp", "m": "decimal(4,2)", "f": "double",
                                "extra": "string"}
    rows = {r.k: r for r in got.collect()}
    assert rows[2].n == 5_000_000_000 and rows[1].n == 5 and rows[3].n is None and rows[3].extra == "new"
    assert rows[1].d == dt.datetime(2026, 1, 1) and rows[1].f == 2.5 and str(rows[1].m) == "1.50"
    assert I.read_landed(spark, paths).count() == 3


def test_a_folder_whose_files_differ(spark):
    path = f"{work_dir(spark, 'types')}/x"
    spark.sql("SELECT 1 AS k, 1 AS n").write.parquet(path)
    spark.sql("SELECT 2 AS k, 7L AS n").write.mode("append").parquet(path)
    assert {(r.k, r.n) for r in Y.read_reconciled(spark, [path]).collect()} == {(1, 1), (2, 7)}


def test_what_does_not_fit_is_refused_by_name(spark):
    root = work_dir(spark, "types")
    paths = [write(spark, root, "a", "SELECT 1L AS k, 'x' AS n"), write(spark, root, "b", "SELECT 1L AS k, 5 AS n")]
    with pytest.raises(Y.TypeConflict, match="column n: string and int"):
        Y.read_reconciled(spark, paths)
    expected = spark.sql("SELECT 1 AS k, 'x' AS n").schema
    with pytest.raises(Y.TypeConflict, match="column k: bigint does not fit into int"):
        Y.read_reconciled(spark, paths[:1], expected)
    assert Y.read_reconciled(spark, paths[1:], spark.sql("SELECT 1L AS k, 1L AS n, 1 AS z").schema).dtypes == [
        ("k", "bigint"), ("n", "bigint"), ("z", "int")]
