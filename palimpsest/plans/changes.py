"""Change-log plans: decoding, current state, transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest import schemas as S
from palimpsest.functions import clean_currency, clean_email, row_image
from palimpsest.operators.history import ROWS_PER_SLOT, with_neighbours
from palimpsest.operators.latest import latest_by

DELIVERY = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]


def parse_messages(messages: DataFrame) -> DataFrame:
    """``messages`` with the parsed value in a column ``e``, for readers that need it more than once."""
    return messages.withColumn("e", F.from_json("value", S.CHANGE_ENVELOPE))


def is_broken() -> Column:
    """A parsed message that is no change event: broken JSON, or no operation or position."""
    return F.col("value").isNotNull() & ~F.coalesce(
        F.col("e.op").isNotNull() & F.col("e.source.lsn").isNotNull(), F.lit(False))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The messages that ``decode_messages`` leaves out as broken (X4), as they came."""
    return parse_messages(messages).where(is_broken()).drop("e")


def decode_messages(messages: DataFrame) -> DataFrame:
    """Envelope text to flat change rows (X4, F16, F11); images stay JSON text.

    Tombstones carry no value and are dropped here: the preceding delete event
    already says everything. Broken values never become events; see
    ``rejected_messages``. Snapshot reads take the same path (X10).
    """
    return decode_parsed(parse_messages(messages))


def decode_parsed(parsed: DataFrame) -> DataFrame:
    """The same from messages that are parsed already."""
    return (
        parsed.where(F.col("value").isNotNull())
        .where(F.col("e.op").isNotNull() & F.col("e.source.lsn").isNotNull())
        .select(
            F.col("e.op").alias("op"), F.col("e.source.lsn").alias("lsn"),
            F.col("e.source.txId").alias("tx_id"),
            F.timestamp_millis("e.source.ts_ms").alias("source_ts"),
            F.timestamp_millis("e.ts_ms").alias("captured_at"),
            F.col("e.source.snapshot").alias("snapshot"), F.col("key").alias("_key"),
            F.col("e.before").alias("before"), F.col("e.after").alias("after"),
            F.col("topic").alias("_kafka_topic"), F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset")))


def entity_of(topic: Column, prefix: str) -> Column:
    """Table name of a topic."""
    return F.when(F.startswith(topic, F.lit(prefix)), F.right(topic, F.char_length(topic) - len(prefix))) \
        .otherwise(topic)


def drop_redelivered(log: DataFrame, *values: str | Column) -> DataFrame:
    """One row per message position (X7), reduced to ``values`` when given.

    All copies of a position carry the same content, so a distinct over the
    position and the few values a plan needs is enough: it hashes narrow rows
    and collapses copies before the exchange, and no image text is moved.
    """
    if not values:
        return log.dropDuplicates(DELIVERY)
    return log.select(*DELIVERY, *values).distinct().drop(*DELIVERY)


def booking_state(log: DataFrame) -> DataFrame:
    """Last known state of every booking, deleted ones included.

    Only the latest image of a key is kept, in log order, and only that one is parsed; a
    repeated delivery has the same position and content, so either copy may win.
    """
    image = row_image(F.col("op"), F.col("before"), F.col("after")).alias("image")
    rows = log.select("_key", "op", "lsn", "_kafka_offset", image)
    last = latest_by(rows, ["_key"], F.desc("lsn"), F.desc("_kafka_offset")).withColumn(
        "row", F.from_json("image", S.BOOKING_IMAGE))
    return last.select(
        "row.booking_id", "row.customer_id", "row.hotel_id",
        F.date_from_unix_date("row.check_in").alias("check_in"),
        F.date_from_unix_date("row.check_out").alias("check_out"),
        "row.status", F.col("row.total_amount").cast(S.MONEY).alias("total_amount"),
        clean_currency(F.col("row.currency")).alias("currency"),
        F.col("row.created_at").cast("timestamp").alias("created_at"),
        F.col("row.updated_at").cast("timestamp").alias("updated_at"),
        (F.col("op") == "d").alias("is_deleted"), F.col("op").alias("last_op"),
        F.col("lsn").alias("last_lsn"))


def customer_versions(log: DataFrame) -> DataFrame:
    """Versions by event time (valid from the commit), including the ones that
    a daily feed never sees. Same columns as the batch version list.

    Two commits of one customer within the same instant collapse to the later
    log position; deletes end no version here and are left to the state.
    """
    image = row_image(F.col("op"), F.col("before"), F.col("after")).alias("image")
    rows = log.where(F.col("op") != "d").select("_key", "lsn", "_kafka_offset", "source_ts", image)
    last = latest_by(rows, ["_key", "source_ts"], F.desc("lsn"), F.desc("_kafka_offset")).withColumn(
        "row", F.from_json("image", S.CUSTOMER_IMAGE))
    return last.select(
        "row.customer_id", "row.first_name", "row.last_name",
        clean_email(F.col("row.email")).alias("email"), "row.loyalty_tier",
        F.col("row.created_at").cast("timestamp").alias("created_at"),
        F.col("source_ts").alias("updated_at"))


def _status(image: str) -> Column:
    return F.from_json(image, T.StructType([T.StructField("status", T.StringType())]))["status"]


def status_transitions(log: DataFrame) -> DataFrame:
    """Every status change with both sides, from the two images of the event."""
    before, after = _status("before"), _status("after")
    changed = log.where(F.col("op").isin("u", "d"))
    return drop_redelivered(
        changed, "_key", "lsn", "source_ts", "op",
        before.alias("status_before"), after.alias("status_after"),
    ).where(~F.col("status_before").eqNullSafe(F.col("status_after")))


def time_in_state(log: DataFrame, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """How long each state lasted until the next change of the key (W10); a busy key is cut
    into slots of its log positions."""
    events = drop_redelivered(
        log, "_key", "lsn", "source_ts", "op", _status("after").alias("status"))
    chained = with_neighbours(
        events, ["_key"], "lsn", ["source_ts", "op", "status"], rows_per_slot)
    return chained.where((F.col("op") != "d") & F.col("_next").isNotNull()).select(
        "_key", "lsn", "status", F.col("_next.status").alias("next_status"),
        F.col("_next.op").alias("next_op"),
        (F.unix_micros("_next.source_ts") - F.unix_micros("source_ts")).alias("micros_in_state"))


def _updates_per_key(log: DataFrame) -> DataFrame:
    updates = drop_redelivered(log.where("op = 'u'"), "_key")
    return updates.groupBy("_key").agg(F.count("*").alias("changes"))


def changes_per_key(log: DataFrame) -> DataFrame:
    """Updates, keys touched and transitions that one read per window loses
    (A21, A23): all but the last change of a key."""
    total = _updates_per_key(log).agg(
        F.coalesce(F.sum("changes"), F.lit(0)).alias("updates"), F.count("*").alias("keys"))
    return total.select(
        "updates", "keys", (F.col("updates") - F.col("keys")).alias("lost"),
        F.round(100 * F.try_divide(F.col("updates") - F.col("keys"), F.col("updates")), 1)
        .alias("lost_pct"),
        F.round(F.try_divide("updates", "keys"), 2).alias("events_per_key"))


def change_distribution(log: DataFrame) -> DataFrame:
    """How many keys changed once, twice, ...."""
    return _updates_per_key(log).groupBy("changes").agg(F.count("*").alias("keys"))


def capture_latency(log: DataFrame) -> DataFrame:
    """Commit to capture, in milliseconds, per operation."""
    micros = F.unix_micros("captured_at") - F.unix_micros("source_ts")
    events = drop_redelivered(log, "op", F.floor(micros / F.lit(1000)).alias("ms"))
    return events.groupBy("op").agg(
        F.count("*").alias("n"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"),
        F.percentile_approx("ms", 0.5, 100000).alias("median_ms"))


def offset_gaps(log: DataFrame) -> DataFrame:
    """Messages missing between the first and last position of a partition (X11)."""
    seen = log.groupBy("_kafka_topic", "_kafka_partition").agg(
        F.min("_kafka_offset").alias("first_offset"), F.max("_kafka_offset").alias("last_offset"),
        F.count("*").alias("rows"), F.countDistinct("_kafka_offset").alias("positions"))
    expected = F.col("last_offset") - F.col("first_offset") + 1
    return seen.withColumns({
        "missing": expected - F.col("positions"),
        "redelivered": F.col("rows") - F.col("positions")})


def ghost_rows(batch_state: DataFrame, active: DataFrame) -> DataFrame:
    """Rows a batch feed still shows although the source deleted them."""
    return batch_state.join(active.select("booking_id"), "booking_id", "left_anti")


def feeds_side_by_side(batch_state: DataFrame, log_state: DataFrame) -> DataFrame:
    """What the batch feed and the change log hold (G11), in one grouped pass
    over the ids of both."""
    yes, no = F.lit(True), F.lit(False)
    ids = batch_state.select(
        "booking_id", yes.alias("batch"), no.alias("active"), no.alias("deleted")
    ).unionByName(log_state.select(
        "booking_id", no.alias("batch"), (~F.col("is_deleted")).alias("active"),
        F.col("is_deleted").alias("deleted")))
    per_id = ids.groupBy("booking_id").agg(
        *[F.bool_or(c).alias(c) for c in ("batch", "active", "deleted")])
    return per_id.agg(
        F.count_if("batch").alias("batch_rows"), F.count_if("active").alias("cdc_rows"),
        F.count_if("deleted").alias("deletes"),
        F.count_if(F.col("batch") & ~F.col("active")).alias("ghosts"))


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages produced but not committed, for every partition of the topics
    (X8): a partition nobody has committed yet counts from its first offset.

    ``end_offsets``: topic, partition, low, high; ``committed``: topic,
    partition, offset (next to read).
    """
    return (
        end_offsets.join(committed, ["topic", "partition"], "left")
        .withColumn("lag", F.col("high") - F.coalesce("offset", "low"))
        .select("topic", "partition", "low", "high", "offset", "lag"))
