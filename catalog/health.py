"""Pipeline health queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from palimpsest import schemas as S
from palimpsest.plans import health as H
from palimpsest.plans import reconcile as R
from palimpsest.sources import event_lines as L
from palimpsest.sources.inventory import partition_inventory
from palimpsest.sources.raw import DayTable

AS_OF = "2024-01-31 00:00:00"
EVENT_COLUMNS = (
    "horodatage, evenement, dag_id, task_id, run_id, logical_date, tentative, retries, "
    "relances_max, duree_tentative_s, exception_type, exception_message, scenario_runbook")


@query("event_shape", f"SELECT {EVENT_COLUMNS} FROM attempts", "attempts")
def _(t):
    """P21, P20."""
    return t.events


@query("events_scan", """
    SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 500 = 499) AS rejected,
           count(*) FILTER (WHERE event_id % 500 <> 499 AND scenario_runbook = 'S1') AS s1
    FROM attempts""", "attempts")
def _(t):
    """JSON lines written and read back, broken ones counted."""
    root = t.fresh_folder("events")
    t.event_lines().write.text(f"{root}/log")
    events = L.read_tolerant(t.spark, f"{root}/log")
    return events.agg(
        F.count("*").alias("lines"), F.count_if("rejected").alias("rejected"),
        F.count_if(F.col("scenario_runbook") == "S1").alias("s1"))


@query("metrics_load", f"""
    SELECT {EVENT_COLUMNS}, TIMESTAMP '2024-02-01' AS _charge_le, DATE '2024-01-05' AS jour
    FROM attempts WHERE CAST(horodatage AS DATE) = DATE '2024-01-05' AND event_id % 500 <> 499""",
       "attempts")
def _(t):
    """Two days loaded, one of them emptied by a replay."""
    root = t.fresh_folder("metrics")
    metrics = DayTable(
        t.spark, f"pipeline_metrics_{root[-12:]}", L.METRICS, ["horodatage"], f"{root}/metrics",
        day="jour").create()
    t.event_lines().write.text(f"{root}/log")
    t.event_lines().limit(0).write.text(f"{root}/empty")
    for path, day in [("log", "2024-01-05"), ("log", "2024-01-06"), ("empty", "2024-01-06")]:
        L.load_day(t.spark, f"{root}/{path}", metrics, day, "2024-02-01", "2024-02-01 00:00:00")
    return metrics.read()


@query("metrics_rejects", """
    SELECT event_id % 500 = 499 AS rejected, count(*) AS n FROM attempts GROUP BY 1""", "attempts")
def _(t):
    """Lines of the event log that cannot be used, beside the others."""
    root = t.fresh_folder("lines")
    t.event_lines().write.text(root)
    return L.read_tolerant(t.spark, root).groupBy("rejected").agg(F.count("*").alias("n"))


@query("incident_classes", """
    SELECT exception_type, scenario_runbook, count(*) AS n FROM attempts
    WHERE evenement <> 'succes' GROUP BY ALL""", "attempts")
def _(t):
    """P20: first matching signature."""
    return t.events.where("evenement <> 'succes'").groupBy(
        "exception_type", "scenario_runbook").agg(F.count("*").alias("n"))


@query("dead_pipelines", """
    SELECT dag_id, max(horodatage) AS dernier_succes,
           date_sub('hour', max(horodatage), TIMESTAMP '2024-02-02') AS heures
    FROM attempts WHERE evenement = 'succes' GROUP BY 1
    HAVING date_sub('hour', max(horodatage), TIMESTAMP '2024-02-02') > 26""", "attempts")
def _(t):
    """A13, F13, F14."""
    return H.dead_pipelines(t.events, "2024-02-02 00:00:00")


@query("slow_tasks", """
    SELECT * FROM (WITH done AS (SELECT dag_id, task_id, horodatage, duree_tentative_s FROM attempts
                  WHERE evenement = 'succes' AND horodatage >= TIMESTAMP '2024-01-17')
    SELECT *, (SELECT quantile_disc(m.duree_tentative_s, 0.5) FROM done m
               WHERE m.dag_id = d.dag_id AND m.task_id = d.task_id) AS med_s
    FROM done d WHERE duree_tentative_s > 2 * (SELECT quantile_disc(m.duree_tentative_s, 0.5)
        FROM done m WHERE m.dag_id = d.dag_id AND m.task_id = d.task_id))""", "attempts")
def _(t):
    """A12, J9."""
    return H.slow_tasks(t.events, AS_OF)


@query("uncovered_incidents", """
    SELECT exception_type, exception_message, count(*) AS n, max(horodatage) AS dernier
    FROM attempts WHERE evenement IN ('echec', 'relance') AND scenario_runbook IS NULL
    GROUP BY 1, 2""", "attempts")
def _(t):
    """A14, P22."""
    return H.uncovered_incidents(t.events)


@query("detection_latency", """
    SELECT run_id, task_id, begun AS started_at, failed_at,
           CAST(epoch_us(failed_at) - epoch_us(begun) AS BIGINT) AS latency_us
    FROM (SELECT run_id, task_id,
                 arg_min(horodatage - to_microseconds(CAST(round(duree_tentative_s * 1000000)
                         AS BIGINT)), horodatage) FILTER (WHERE evenement = 'relance') AS begun,
                 max(horodatage) FILTER (WHERE evenement = 'echec') AS failed_at
          FROM attempts GROUP BY 1, 2)
    WHERE begun IS NOT NULL AND failed_at IS NOT NULL""", "attempts")
def _(t):
    """A27."""
    return H.detection_latency(t.events)


ENTITIES = ["hotels", "customers", "bookings", "payments"]
RAW = " ".join(f"raw_{e}" for e in ENTITIES)
INVENTORY = " UNION ALL ".join(f"""
    SELECT '{e}' AS table_name, strftime(_interval_start, '%Y%m%d') AS partition_id,
           count(*) AS total_rows FROM raw_{e} GROUP BY 2""" for e in ENTITIES)


def _inventory(t):
    return reduce(DataFrame.unionByName, [partition_inventory(getattr(t, f"raw_{e}"), e) for e in ENTITIES])


@query("partition_inventory", INVENTORY, RAW)
def _(t):
    """S16."""
    return _inventory(t)


@query("expiring_partitions", f"""
    SELECT table_name, partition_id, CAST(strptime(partition_id, '%Y%m%d') AS DATE) + 60 AS expire_le,
           CAST(CAST(strptime(partition_id, '%Y%m%d') AS DATE) + 60 - DATE '1995-03-15' AS INTEGER)
               AS jours_restants, total_rows
    FROM ({INVENTORY})
    WHERE CAST(strptime(partition_id, '%Y%m%d') AS DATE) + 60 <= DATE '1995-03-22'""",
       RAW)
def _(t):
    """S16, P23, F20."""
    return H.expiring_partitions(_inventory(t), "1995-03-15")


@query("first_expiry", f"""
    SELECT table_name, min(partition_id) AS premiere_partition, count(*) AS partitions,
           CAST(strptime(min(partition_id), '%Y%m%d') AS DATE) + 60 AS expire_vers
    FROM ({INVENTORY}) GROUP BY 1""", RAW)
def _(t):
    """S16."""
    return H.first_expiry(_inventory(t))


LOST_DAYS = {"hotels": "1994-06-01", "customers": "1994-06-04", "bookings": "1998-01-05", "payments": "1998-01-05"}


@query("only_in_partition", " UNION ALL ".join(f"""
    SELECT '{e}' AS t, count(*) AS cles, count(*) FILTER (WHERE days = 1 AND seen) AS perdues,
           round(100 * (count(*) FILTER (WHERE days = 1 AND seen) / count(*)), 2) AS pct
    FROM (SELECT {S.PRIMARY_KEY[e]}, count(DISTINCT _interval_start) AS days,
                 bool_or(_interval_start = DATE '{day}') AS seen
          FROM raw_{e} GROUP BY 1)""" for e, day in LOST_DAYS.items()), RAW)
def _(t):
    """All tables."""
    return reduce(DataFrame.unionByName, [
        R.only_in_partition(getattr(t, f"raw_{e}"), e, S.PRIMARY_KEY[e], day) for e, day in LOST_DAYS.items()])


