"""Windowed batch ingestion into day-partitioned tables.

The content of a day depends only on its closed-open window of the source:
running a window again replaces exactly that day and nothing else.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import schemas as S
from palimpsest.sources.publish import Folder, Journal, Switch, values_in
from palimpsest.sources.types import read_reconciled

DAY = "_interval_start"
EPOCH = "1970-01-01"


class WindowError(ValueError):
    """The window is missing, still open, or not exactly one day."""


class GateError(ValueError):
    """A landed batch failed validation and must not be loaded."""


class SchemaError(ValueError):
    """A column of the table is missing from the incoming batch."""


def _instant(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def require_closed_day(day: str, as_of: str) -> tuple[str, str]:
    """Bounds of a logical day; refuses a day that is not over at ``as_of``."""
    if not day:
        raise WindowError("no logical day: the window is undefined")
    start = date.fromisoformat(day)
    end = start + timedelta(days=1)
    if datetime.combine(end, datetime.min.time()) > datetime.fromisoformat(as_of):
        raise WindowError(f"window [{start}, {end}) is not closed at {as_of}")
    return start.isoformat(), end.isoformat()


def scan_window(source: DataFrame, start: str, end: str, column: str = "updated_at") -> DataFrame:
    """Rows of ``[start, end)`` (S1). The bounds are literals on a plain column,
    so they reach the scan of a file or database source."""
    return source.where((F.col(column) >= _instant(start)) & (F.col(column) < _instant(end)))


SLICES = 24


def jdbc_window(
    spark: SparkSession, url: str, table: str, start: str, end: str,
    properties: dict[str, str], key: str, slices: int = SLICES, column: str = "updated_at",
) -> DataFrame:
    """The same scan against a database, cut into parts of about equal numbers of rows that
    executors read in parallel, each with its own predicate. The cuts come from a first scan
    of the window's times and keys alone."""
    options = {"fetchsize": "10000", "connectTimeout": "10", **properties}
    window = f"(SELECT {column}, {key} FROM {table} WHERE {_between(column, start, end)}) w"
    cuts = equi_depth_cuts(spark.read.jdbc(url, window, properties=options), slices, column, key)
    return spark.read.jdbc(
        url, table, predicates=window_predicates(start, end, cuts, column, key), properties=options)


def _stamp(at: datetime) -> str:
    return f"TIMESTAMP '{at:%Y-%m-%d %H:%M:%S.%f}'"


def _between(column: str, start: str, end: str) -> str:
    low, high = (_stamp(datetime.fromisoformat(t)) for t in (start, end))
    return f"{column} >= {low} AND {column} < {high}"


def equi_depth_cuts(
    rows: DataFrame, slices: int = SLICES, column: str = "updated_at", key: str = "id",
) -> list[tuple[datetime, int | None]]:
    """Places (time, key) that cut ``rows`` into about ``slices`` parts of equal size.

    Quantiles of the time first. A time that takes several quantiles holds more rows than a
    part should: it is cut again at quantiles of its whole-number keys.
    """
    shares = lambda n: F.array(*[F.lit(i / n) for i in range(1, n)])
    found = rows.agg(F.percentile_approx(F.unix_micros(column), shares(slices), 100_000).alias("q")).first().q or []
    cuts: list[tuple[int, int | None]] = []
    heavy = sorted({q for q in found if found.count(q) > 1})
    inside = rows.where(F.unix_micros(column).isin(heavy)).groupBy(F.unix_micros(column).alias("at")).agg(
        F.percentile_approx(key, shares(slices), 100_000).alias("keys")).collect() if heavy else []
    keys = {r["at"]: r["keys"] for r in inside}
    for q in dict.fromkeys(found):
        cuts.append((q, None))
        if q in keys:  # as many parts as quantiles fell on it, and the two it shares with its neighbours
            parts = found.count(q) + 1
            picked = [keys[q][i * (slices - 1) // parts] for i in range(1, parts)]
            cuts += [(q, k) for k in dict.fromkeys(picked)] + [(q + 1, None)]
    epoch = datetime(1970, 1, 1)
    return [(epoch + timedelta(microseconds=at), k) for at, k in dict.fromkeys(cuts)]


def window_predicates(
    start: str, end: str, cuts: Sequence[tuple[datetime, int | None]], column: str = "updated_at",
    key: str = "id",
) -> list[str]:
    """Predicates that cover ``[start, end)`` once, cut at ``cuts`` (ascending)."""
    first, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
    inner = [c for c in cuts if (first, None) != c and first <= c[0] < last]

    def at_least(place: tuple[datetime, int | None]) -> str:
        at, k = place
        if k is None:
            return f"{column} >= {_stamp(at)}"
        return f"({column} > {_stamp(at)} OR ({column} = {_stamp(at)} AND {key} >= {k}))"

    def before(place: tuple[datetime, int | None]) -> str:
        at, k = place
        if k is None:
            return f"{column} < {_stamp(at)}"
        return f"({column} < {_stamp(at)} OR ({column} = {_stamp(at)} AND {key} < {k}))"

    places = [(first, None), *inner, (last, None)]
    return [f"{at_least(a)} AND {before(b)}" for a, b in zip(places, places[1:])]


def landing_path(root: str, entity: str, day: str) -> str:
    """One folder per window: the same window always lands in the same place."""
    return f"{root.rstrip('/')}/{entity}/dt={day}"


def land_days(df: DataFrame, root: str, first: str, last: str) -> list[str]:
    """Write the rows of a range of days, each day to its own landing folder, and clear the
    folders of days that have none: the same places as day by day. Returns the days with rows.

    The source is read once, in one job; which days it had is told by the folders it made. They
    are moved into place afterwards, so a failing read leaves the landing area as it was.
    """
    spark, day = df.sparkSession, date.fromisoformat(first)
    fresh = Folder(spark, f"{root.rstrip('/')}/_landing-{uuid.uuid4().hex}")
    # adaptive execution sizes the files: a hot day is cut, small days of one task share it
    dated = df.withColumn("dt", F.date_format("updated_at", "yyyy-MM-dd")).hint("rebalance", F.col("dt"))
    dated.sortWithinPartitions("dt", "updated_at").write.partitionBy("dt").parquet(fresh.path)
    landed, places = values_in(fresh, "dt"), Folder(spark, root)
    while day.isoformat() <= last:
        name = f"dt={day.isoformat()}"
        places.remove(name)
        if day.isoformat() in landed:
            places.take(name, Folder(spark, f"{fresh.path}/{name}"))
        day += timedelta(days=1)
    fresh.remove()
    return landed


def land(df: DataFrame, path: str) -> None:
    """Write a window's rows, replacing what an earlier run left.

    The commit protocol publishes files only when the job succeeds, and an
    empty window replaces its old rows by none.
    """
    df.sortWithinPartitions("updated_at").write.mode("overwrite").parquet(path)


def read_landed(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None,
) -> DataFrame:
    """Landed files, columns matched by name and missing ones filled with NULL
    (S5, U4). A known schema avoids reading every footer; without one the files' types
    are widened to hold all of them (see ``read_reconciled``)."""
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return read_reconciled(spark, paths)


def add_lineage(df: DataFrame, day: str, ingested_at: str | None = None) -> DataFrame:
    """Load time, file (of a landed day its folder) and logical day (P1). Load time is audit data: the only
    clock reading of the batch path."""
    now = F.current_timestamp() if ingested_at is None else _instant(ingested_at)
    return df.withColumns({
        "_ingested_at": now,
        "_source_file": F.regexp_replace(
            F.input_file_name(), "(/dt=[^/]*)/[^/]*$", "$1"),
        DAY: F.lit(day).cast("date")})


def gate(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Measurements that decide whether a batch may be loaded (A20): one pass,
    keys counted through a two-stage distinct."""
    return df.agg(*_measures(key, start, end))


def _measures(key: str, start: str, end: str) -> list:
    at = F.col("updated_at")
    return [
        F.count("*").alias("rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        (F.count(key) - F.countDistinct(key)).alias("repeated_keys"),
        F.count_if((at < _instant(start)) | (at >= _instant(end))).alias("outside_window"),
        F.min(at).alias("first_update"), F.max(at).alias("last_update")]


def gate_days(df: DataFrame, key: str, start: str, end: str, day: str = "dt") -> DataFrame:
    """The same measurements, one row a day of a range, in one pass."""
    return df.groupBy(day).agg(*_measures(key, start, end))


def gate_problems(df: DataFrame, key: str, start: str, end: str) -> tuple[int, list[str]]:
    """Rows of the batch and what is wrong with it (C17)."""
    missing = sorted({key, "updated_at"} - set(df.columns))
    if missing:
        return 0, [f"missing columns {missing}"]
    m = gate(df, key, start, end).first()
    return m.rows, _named_problems(m)


def _named_problems(m) -> list[str]:
    named = {
        "null key": m.null_keys, "repeated key": m.repeated_keys,
        "outside the window": m.outside_window}
    return [f"{what}: {n} rows" for what, n in named.items() if n]


@dataclass(frozen=True)
class DayTable:
    """A table partitioned by logical day, clustered by key inside a day."""

    spark: SparkSession
    name: str
    schema: T.StructType
    cluster: Sequence[str]
    location: str
    day: str = DAY

    def create(self) -> DayTable:
        """Declare the layout once, outside the window jobs."""
        fields = [f for f in self.schema.fields if f.name != self.day]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, `{self.day}` DATE) "
            f"USING parquet PARTITIONED BY (`{self.day}`) LOCATION '{self.location}'")
        return self

    @property
    def journal(self) -> Journal:
        return Journal(self.spark, self.name, self.day, self.location)

    def read(self) -> DataFrame:
        """The table as of its last commit, also after a crash of the writer."""
        self.journal.carry_out()
        return self.spark.table(self.name)

    def rows_on(self, day: str) -> DataFrame:
        return self.read().where(F.col(self.day) == F.lit(day).cast("date"))

    def _align(self, df: DataFrame) -> list[str]:
        """Add new columns to the table, refuse missing ones."""
        known = [c for c in self.read().columns if c != self.day]
        missing = [c for c in known if c not in df.columns]
        if missing:
            raise SchemaError(f"{self.name}: columns {missing} are gone from the source")
        for f in df.schema.fields:
            if f.name not in known and f.name != self.day:
                self.spark.sql(
                    f"ALTER TABLE {self.name} ADD COLUMNS "
                    f"(`{f.name}` {f.dataType.simpleString()})")
                known.append(f.name)
        return known

    def _clustered(self, df: DataFrame, *lead: str) -> DataFrame:
        """Range-partition and sort by the cluster columns (S15), so that files
        cover narrow key ranges and their statistics prune; adaptive execution
        sizes the ranges, and a hot range is cut where its keys differ."""
        columns = [*lead, *self.cluster]
        return df.repartitionByRange(*columns).sortWithinPartitions(*columns)

    def replace_day(self, df: DataFrame, day: str, on_empty: str = "clear") -> None:
        """Replace one day (S6): an empty frame clears the day, and no other day can be touched.

        Rows of another day are an extraction error (S8). ``on_empty="keep"`` leaves the
        stored day alone when there is nothing to write (S14).
        """
        if self.day not in df.columns:
            df = df.withColumn(self.day, F.lit(day).cast("date"))
        self._replace(df, day, day, f"the partition {day}", on_empty)

    def replace_days(
        self, df: DataFrame, first: str, last: str, after: Callable[[str], None] = lambda step: None,
    ) -> None:
        """Replace every day of ``[first, last]`` as one step.

        Days are independent, so a long backfill is one clustered write; days of the range that
        got no row are dropped, as a single-day run would have cleared them. ``after`` is told
        of each step done: tests raise in it to provoke a crash.
        """
        self._replace(df, first, last, f"the days {first} to {last}", "clear", after)

    def _replace(
        self, df: DataFrame, first: str, last: str, what: str, on_empty: str,
        after: Callable[[str], None] = lambda step: None,
    ) -> None:
        """Write beside the table, then commit the switch of all days (see ``publish``)."""
        self.journal.carry_out()
        known = self._align(df)
        types = {f.name: f.dataType for f in self.spark.table(self.name).schema}
        rows = df.select(*[F.col(c).cast(types[c]).alias(c) for c in [*known, self.day]])
        version = Folder(self.spark, f"{self.location.rstrip('/')}-versions/{uuid.uuid4().hex}")
        self._clustered(rows, self.day).write.partitionBy(self.day).parquet(version.path)
        filled = values_in(version, self.day)
        if not all(first <= d <= last for d in filled):  # a row without a day has a folder of its own
            version.remove()
            raise GateError(f"{self.name}: rows outside {what}")
        after("written")
        if not filled and on_empty == "keep":
            return
        self.journal.commit(Switch(
            {d: f"{version.path}/{self.day}={d}" for d in filled},
            [d for d in self.journal.values() if first <= d <= last and d not in filled]))
        after("committed")
        self.journal.carry_out(after)

    def vacuum(self) -> None:
        """Remove the files of replaced days; no reader may still be at work on them."""
        self.journal.carry_out()
        session = self.spark._jsparkSession.sessionState()
        name = session.sqlParser().parseTableIdentifier(self.name)
        none = self.spark.sparkContext._jvm.scala.Option.empty()
        parts = session.catalog().listPartitions(name, none)
        used = {parts.apply(i).location().toString().rstrip("/").split("/")[-2] for i in range(parts.size())}
        versions = Folder(self.spark, f"{self.location.rstrip('/')}-versions")
        for version in versions.names():
            if version not in used:
                versions.remove(version)


def raw_table(spark: SparkSession, entity: str, name: str, location: str) -> DayTable:
    schema = T.StructType(S.SOURCE_TABLES[entity].fields + S.LINEAGE.fields)
    return DayTable(spark, name, schema, [S.PRIMARY_KEY[entity]], location).create()


def ingest_window(
    source: DataFrame, entity: str, table: DayTable, landing: str, day: str, as_of: str,
    *, on_empty: str = "keep", ingested_at: str | None = None,
) -> int:
    """Extract, validate, load one closed day (G1): returns the rows loaded.

    The window is landed once and the gate and the load read the landed files,
    so a mutable source is read only once. A failing gate leaves the table as
    it was and the landed files in place for inspection.
    """
    start, end = require_closed_day(day, as_of)
    path = landing_path(landing, entity, day)
    land(scan_window(source, start, end), path)
    landed = read_landed(table.spark, [path], source.schema)
    rows, problems = gate_problems(landed, S.PRIMARY_KEY[entity], start, end)
    if problems:
        raise GateError(f"{entity} {day}: " + "; ".join(problems))
    if rows or on_empty == "clear":
        table.replace_day(add_lineage(landed, day, ingested_at), day)
    return rows


def backfill(
    source: DataFrame, entity: str, table: DayTable, landing: str, first: str, last: str,
    as_of: str, *, keeps_history: bool = False, ingested_at: str | None = None,
) -> None:
    """Reload a range of closed days in one job (G2), late rows included.

    The source is read once, by one job, into one landing folder a day; the gate looks at
    every day and the load reads the landed files, so that a day is refused, and
    traced to its folder, as if it had been loaded alone.

    ``keeps_history`` marks tables whose old versions only exist in the raw
    layer: a mutable source no longer has them, so reloading erases them.
    """
    require_closed_day(last, as_of)
    if keeps_history:
        warnings.warn(
            f"{entity}: reloading {first}..{last} from the source erases row versions "
            "that only the raw table still holds", stacklevel=2)
    end = (date.fromisoformat(last) + timedelta(days=1)).isoformat()
    root = f"{landing.rstrip('/')}/{entity}"
    landed_days = land_days(scan_window(source, first, end), root, first, last)
    days = T.StructType([*source.schema.fields, T.StructField("dt", T.StringType())])
    landed = table.spark.read.option("basePath", root).schema(days).parquet(
        *[landing_path(landing, entity, d) for d in landed_days]) if landed_days else \
        table.spark.createDataFrame([], days)
    bad = [f"{m.dt}: " + ", ".join(_named_problems(m)) for m in gate_days(
        landed, S.PRIMARY_KEY[entity], first, end).collect() if _named_problems(m)]
    if bad:
        raise GateError(f"{entity}: " + "; ".join(sorted(bad)))
    dated = add_lineage(landed, first, ingested_at).withColumn(DAY, F.to_date("dt")).drop("dt")
    table.replace_days(dated, first, last)


def snapshot(
    source: DataFrame, entity: str, table: DayTable, landing: str, start: str, *,
    force: bool = False, ingested_at: str | None = None,
) -> bool:
    """Everything older than ``start`` into the partition of its eve.

    Windows and snapshot never overlap. Refuses to run twice, because a later
    run would mix two instants of the source; returns whether it wrote. The rows
    are landed once; gate and load read the landed files.
    """
    eve = (date.fromisoformat(start) - timedelta(days=1)).isoformat()
    if not force and not table.rows_on(eve).isEmpty():
        return False
    path = landing_path(landing, entity, eve)
    land(scan_window(source, EPOCH, start), path)
    landed = read_landed(table.spark, [path], source.schema)
    _, problems = gate_problems(landed, S.PRIMARY_KEY[entity], EPOCH, start)
    if problems:
        raise GateError(f"{entity} {eve}: " + "; ".join(problems))
    table.replace_day(add_lineage(landed, eve, ingested_at), eve)
    return True
