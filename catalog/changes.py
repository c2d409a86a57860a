"""Change-log and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from palimpsest.plans import changes as C
from palimpsest.plans import staging as G
from catalog import testdata as D
from palimpsest.streaming import changes as X


@query("cdc_decode", """
    SELECT op, lsn, event_id AS tx_id, date_trunc('millisecond', source_ts) AS source_ts,
           date_trunc('millisecond', captured_at) AS captured_at,
           CASE WHEN event_id < 100 THEN 'true' ELSE 'false' END AS snapshot,
           CAST(key AS VARCHAR) AS _key, 'bookings' AS entity, _kafka_partition,
           2 * event_id AS _kafka_offset,
           CASE WHEN op <> 'c' THEN status_old END AS status_before,
           CASE WHEN op <> 'd' THEN status_new END AS status_after
    FROM event_log""", "event_log")
def _(t):
    """Envelopes to rows, tombstones dropped."""
    rows = C.decode_messages(D.change_messages(t.event_log))
    return rows.select(
        "op", "lsn", "tx_id", "source_ts", "captured_at", "snapshot", "_key",
        C.entity_of(F.col("_kafka_topic"), D.TOPIC_PREFIX).alias("entity"), "_kafka_partition",
        "_kafka_offset", F.get_json_object("before", "$.status").alias("status_before"),
        F.get_json_object("after", "$.status").alias("status_after"))


LATEST = """
    SELECT DISTINCT ON (key) key AS booking_id, user_id AS customer_id,
           CAST(k % 10 AS BIGINT) AS hotel_id, DATE '1970-01-01' + CAST(19700 + k AS INT) AS check_in,
           DATE '1970-01-01' + CAST(19701 + k + k % 14 AS INT) AS check_out,
           CASE WHEN op = 'd' THEN status_old ELSE status_new END AS status,
           CAST(value AS DECIMAL(10,2)) AS total_amount, 'EUR' AS currency,
           TIMESTAMP '2024-01-01' AS created_at, source_ts AS updated_at, op = 'd' AS is_deleted,
           op AS last_op, lsn AS last_lsn
    FROM event_log ORDER BY key, lsn DESC"""


@query("cdc_latest", LATEST, "event_log")
def _(t):
    """W5, P15, P16, F23 on a busy log."""
    return C.booking_state(t.event_log)


@query("booking_state", "SELECT * FROM state", "state")
def _(t):
    """W5 on the log behind the fact."""
    return t.state


@query("int_bookings_actives", "SELECT * FROM active", "active")
def _(t):
    """P3."""
    return t.active


@query("cdc_redelivery", """
    SELECT _kafka_partition, count(*) AS delivered, count(DISTINCT _kafka_offset) AS kept
    FROM event_log GROUP BY 1""", "event_log")
def _(t):
    """Rows before and after dropping repeated positions."""
    kept = C.drop_redelivered(t.event_log).select("_kafka_partition", F.lit(1).alias("kept"))
    every = t.event_log.select("_kafka_partition", F.lit(0).alias("kept"))
    return every.unionByName(kept).groupBy("_kafka_partition").agg(
        F.count_if(F.col("kept") == 0).alias("delivered"),
        F.count_if(F.col("kept") == 1).alias("kept"))


@query("cdc_offset_gaps", """
    SELECT 'app.public.bookings' AS _kafka_topic, CAST(event_id % 3 AS INTEGER) AS _kafka_partition,
           min(event_id // 3) AS first_offset, max(event_id // 3) AS last_offset,
           count(*) AS "rows", count(DISTINCT event_id // 3) AS positions,
           CAST(max(event_id // 3) - min(event_id // 3) + 1 - count(DISTINCT event_id // 3)
                AS BIGINT) AS missing,
           CAST(count(*) - count(DISTINCT event_id // 3) AS BIGINT) AS redelivered
    FROM event_log WHERE event_id % 500 <> 4 GROUP BY 2""", "event_log")
def _(t):
    """X11: positions renumbered without gaps per partition, then some lost."""
    log = t.event_log.where("tx_id % 500 <> 4").withColumns({
        "_kafka_partition": (F.col("tx_id") % 3).cast("int"),
        "_kafka_offset": F.floor(F.col("tx_id") / 3)})
    return C.offset_gaps(log)


@query("cdc_latency", """
    SELECT op, count(*) AS n, min(ms) AS min_ms, max(ms) AS max_ms,
           quantile_disc(ms, 0.5) AS median_ms
    FROM (SELECT op, event_id % 900 AS ms FROM events_once) GROUP BY 1""", "events_once")
def _(t):
    """A26."""
    return C.capture_latency(t.event_log)


@query("cdc_transitions", """
    SELECT status_old AS status_before, CASE WHEN op <> 'd' THEN status_new END AS status_after,
           op, count(*) AS n
    FROM events_once WHERE op <> 'c' GROUP BY ALL""", "events_once")
def _(t):
    """What each status became, deletes included."""
    return C.status_transitions(t.event_log).groupBy("status_before", "status_after", "op").agg(
        F.count("*").alias("n"))


@query("cdc_time_in_state", """
    SELECT CAST(key AS VARCHAR) AS _key, lsn, status, next_status, next_op,
           CAST(epoch_us(next_ts) - epoch_us(source_ts) AS BIGINT) AS micros_in_state
    FROM (SELECT key, lsn, op, source_ts, CASE WHEN op <> 'd' THEN status_new END AS status,
                 lead(CASE WHEN op <> 'd' THEN status_new END) OVER w AS next_status,
                 lead(op) OVER w AS next_op, lead(source_ts) OVER w AS next_ts
          FROM events_once WINDOW w AS (PARTITION BY key ORDER BY lsn))
    WHERE op <> 'd' AND next_op IS NOT NULL""", "events_once")
def _(t):
    """How long each state lasted; small slots, so that keys cross them."""
    return C.time_in_state(t.event_log, rows_per_slot=8)


@query("cdc_cancelled_after_confirmed", """
    SELECT count(*) FILTER (WHERE status = 'confirmed') AS confirmed,
           count(*) FILTER (WHERE status = 'confirmed' AND next_status = 'cancelled') AS cancelled
    FROM (SELECT op, CASE WHEN op <> 'd' THEN status_new END AS status,
                 lead(CASE WHEN op <> 'd' THEN status_new END) OVER w AS next_status,
                 lead(op) OVER w AS next_op
          FROM events_once WINDOW w AS (PARTITION BY key ORDER BY lsn))
    WHERE op <> 'd' AND next_op IS NOT NULL""", "events_once")
def _(t):
    """The cancellation rate after confirmation that a daily read cannot see."""
    confirmed = F.col("status") == "confirmed"
    return C.time_in_state(t.event_log).agg(
        F.count_if(confirmed).alias("confirmed"),
        F.count_if(confirmed & (F.col("next_status") == "cancelled")).alias("cancelled"))


@query("lost_transitions", """
    SELECT updates, keys, updates - keys AS lost,
           round(100 * ((updates - keys) / updates), 1) AS lost_pct,
           round(updates / keys, 2) AS events_per_key
    FROM (SELECT count(*) AS updates, count(DISTINCT key) AS keys
          FROM events_once WHERE op = 'u')""", "events_once")
def _(t):
    """A21, A23."""
    return C.changes_per_key(t.event_log)


@query("change_distribution", """
    SELECT changes, count(*) AS keys FROM (
        SELECT key, count(*) AS changes FROM events_once WHERE op = 'u' GROUP BY 1) GROUP BY 1""",
       "events_once")
def _(t):
    """A21."""
    return C.change_distribution(t.event_log)


@query("ghost_rows", """
    SELECT booking_id, status, updated_at FROM stg_bookings WHERE booking_id % 97 = 0""",
       "stg_bookings")
def _(t):
    """Deleted in the source, still shown by the batch feed."""
    return C.ghost_rows(t.stg_bookings, t.active).select("booking_id", "status", "updated_at")


@query("batch_vs_cdc", """
    SELECT (SELECT count(*) FROM stg_bookings) AS batch_rows,
           (SELECT count(*) FROM active) AS cdc_rows,
           (SELECT count(*) FROM state WHERE is_deleted) AS deletes,
           (SELECT count(*) FROM stg_bookings s
            WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.booking_id = s.booking_id)) AS ghosts""",
       "stg_bookings state active")
def _(t):
    """G11."""
    return C.feeds_side_by_side(t.stg_bookings, t.state)


@query("cdc_lag", """
    SELECT 'app.public.bookings' AS topic, p AS "partition", low, high, "offset",
           high - coalesce("offset", low) AS lag
    FROM (SELECT _kafka_partition AS p, min(2 * event_id) AS low,
                 max(2 * event_id + CASE WHEN op = 'd' THEN 1 ELSE 0 END) + 1 AS high,
                 CASE WHEN _kafka_partition <> 2 THEN max(2 * event_id + CASE WHEN op = 'd' THEN 1 ELSE 0 END)
                     FILTER (WHERE source_ts < TIMESTAMP '2024-01-15') + 1 END AS "offset"
          FROM event_log GROUP BY 1)""", "event_log")
def _(t):
    """How far a drained consumer is behind its topics; it has read half of the time, and one
    partition not at all, which still counts."""
    everything = D.change_messages(t.event_log)
    ends = everything.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
    early = t.event_log.where(
        (F.col("source_ts") < F.lit("2024-01-15").cast("timestamp")) & (F.col("_kafka_partition") != 2))
    root = t.fresh_folder("lag")
    D.change_messages(early).repartition(4, "partition", "key").write.json(f"{root}/messages")
    stream = X.file_messages(t.spark, f"{root}/messages", files_per_batch=2)
    X.run_changes(stream, f"{root}/log", f"{root}/checkpoint", D.TOPIC_PREFIX).awaitTermination()
    return C.consumer_lag(ends, X.consumer_positions(t.spark, f"{root}/log"))


@query("cdc_table_counts", """
    SELECT 'bookings' AS entity, count(*) + count(*) FILTER (WHERE op = 'd') AS messages,
           count(*) FILTER (WHERE op = 'd') AS tombstones, CAST(0 AS BIGINT) AS rejected
    FROM event_log
    UNION ALL SELECT 'customers', CAST(count(*) + sum(CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END) AS BIGINT),
           CAST(0 AS BIGINT), CAST(count(*) FILTER (WHERE n = 0) + sum(
               CASE WHEN c_custkey % 13 = 0 AND n = 0 THEN 1 ELSE 0 END) AS BIGINT)
    FROM (SELECT c_custkey, n FROM customer, (VALUES (0),(1),(2)) v(n) WHERE n <= c_custkey % 3
          UNION ALL SELECT c_custkey, n FROM customer, (VALUES (1),(2)) v(n) WHERE n <= c_custkey % 3)""",
       "event_log")
def _(t):
    """Messages, tombstones and broken messages per table, summed over the consumer's batches;
    the customers' first versions are cut short on their way."""
    customers = D.change_messages(t.customer_log)
    cut = F.when(F.contains("value", F.lit('"op":"c"')), F.substring("value", 1, 30)).otherwise(F.col("value"))
    both = D.change_messages(t.event_log).unionByName(customers.withColumn("value", cut))
    root = t.fresh_folder("counts")
    both.repartition(4, "topic", "partition", "key").write.json(f"{root}/messages")
    stream = X.file_messages(t.spark, f"{root}/messages", files_per_batch=2)
    X.run_changes(stream, f"{root}/log", f"{root}/checkpoint", D.TOPIC_PREFIX).awaitTermination()
    return X.batch_counts(t.spark, f"{root}/log").groupBy("entity").agg(
        *[F.sum(c).alias(c) for c in ("messages", "tombstones", "rejected")])


def _message_files(t) -> str:
    """The topics as files, in several batches of work."""
    root = t.fresh_folder("stream")
    D.change_messages(t.event_log).repartition(4, "partition", "key").write.json(f"{root}/messages")
    return root


def _consumed(t):
    root = _message_files(t)
    stream = X.file_messages(t.spark, f"{root}/messages", files_per_batch=2)
    X.run_changes(stream, f"{root}/log", f"{root}/checkpoint", D.TOPIC_PREFIX).awaitTermination()
    return X.read_changes(t.spark, f"{root}/log", "bookings")





@query("cdc_stream_state", LATEST, "event_log")
def _(t):
    """Messages streamed into the log, then the state read from it."""
    return C.booking_state(_consumed(t))


@query("cdc_stream_counts", """
    SELECT op, count(*) AS n, count(DISTINCT _kafka_offset) AS positions FROM event_log GROUP BY 1""",
       "event_log")
def _(t):
    """What the consumer appended, per operation."""
    return _consumed(t).groupBy("op").agg(
        F.count("*").alias("n"), F.countDistinct("_kafka_offset").alias("positions"))


@query("cdc_stream_dedup", """
    SELECT op, count(DISTINCT (_kafka_partition, _kafka_offset)) AS n FROM event_log GROUP BY 1""",
       "event_log")
def _(t):
    """Positions delivered again, in files out of order by weeks, written once."""
    root = _message_files(t)
    stream = X.file_messages(t.spark, f"{root}/messages", files_per_batch=2)
    X.run_distinct_changes(stream, f"{root}/once", f"{root}/once-checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}/once").groupBy("op").agg(F.count("*").alias("n"))


@query("cdc_rejects", """
    SELECT count(*) AS n FROM event_log WHERE _kafka_offset % 25 = 0""", "event_log")
def _(t):
    """Messages cut short in transit are counted, not decoded."""
    cut = F.when(F.col("offset") % 50 == 0, F.substring("value", 1, 30)).otherwise(F.col("value"))
    broken = C.rejected_messages(D.change_messages(t.event_log).withColumn("value", cut))
    return broken.agg(F.count("*").alias("n"))


@query("cdc_stream_upserts", """
    SELECT DISTINCT ON (key) CAST(key AS VARCHAR) AS _key, op, lsn,
           CASE WHEN op = 'd' THEN status_old ELSE status_new END AS status
    FROM event_log ORDER BY key, lsn DESC""", "event_log")
def _(t):
    """The state kept by a running aggregate."""
    root = _message_files(t)
    stream = X.file_messages(t.spark, f"{root}/messages", files_per_batch=2)
    X.run_latest_state(stream, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return X.read_latest_state(t.spark, f"{root}/state").select(
        "_key", "op", "lsn", F.get_json_object("image", "$.status").alias("status"))


@query("active_from_events", f"SELECT * EXCLUDE (is_deleted, last_op, last_lsn) FROM ({LATEST}) "
       "WHERE NOT is_deleted", "event_log")
def _(t):
    """P3 over the busy log."""
    return G.active_bookings(C.booking_state(t.event_log))
