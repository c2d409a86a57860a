"""Change streams: sources, decoding, sinks and state.

Delivery is at least once. Offsets are committed by the checkpoint after the
batch function returns, so a crash in between replays the batch: readers drop
repeated positions (topic, partition, offset).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from palimpsest import schemas as S
from palimpsest.functions import row_image
from palimpsest.plans.changes import (
    DELIVERY, decode_messages, decode_parsed, entity_of, is_broken, parse_messages)
from palimpsest.streaming.upserts import UpsertLog

# Fixed defaults of a micro-batch: so many messages, or so long after the first.
BATCH_MESSAGES, BATCH_SECONDS = 1000, 300
LARGEST_BATCH = 5_000_000  # what is beyond it waits for the next batch
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kafka_options(
    servers: str, topics: Iterable[str], min_messages: int = BATCH_MESSAGES,
    max_seconds: int = BATCH_SECONDS, max_messages: int = LARGEST_BATCH,
) -> dict[str, str]:
    """Options of the Kafka source: from the earliest message, a batch once
    enough messages wait or the delay has passed, and fail on lost messages."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(min_messages),
        "maxTriggerDelay": f"{max_seconds}s",
        "maxOffsetsPerTrigger": str(max_messages),
        "failOnDataLoss": "true",
    }


def kafka_messages(spark: SparkSession, servers: str, topics: Iterable[str]) -> DataFrame:
    """Needs the spark-sql-kafka package on the classpath."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topics)).load()
    return raw.select(
        "topic", "partition", "offset",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """The same messages from files, one file per partition of the work."""
    return (
        spark.readStream.schema(S.MESSAGE).option("maxFilesPerTrigger", files_per_batch)
        .json(path))


def append_changes(
    root: str, prefix: str, after_write: Callable[[int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function: decode and append to one folder per entity.

    A value is parsed once; all entities are written by one job, which counts the broken
    messages as it goes. Only if there are some does a second pass store them under
    ``root``_rejects. What the batch held of each partition goes to ``root``_progress (X8, X9).
    Both have a folder a batch, which a replay replaces. The checkpoint commits the offsets
    when all is done. ``after_write`` runs between write and commit: tests raise in it to
    provoke a replay (X3).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        parsed = parse_messages(batch).observe(seen, F.count_if(is_broken()).alias("broken"))
        rows = decode_parsed(parsed).withColumns({
            "entity": entity_of(F.col("_kafka_topic"), prefix),
            "_ingested_at": F.current_timestamp(),
            "_ingested_day": F.to_date(F.current_timestamp())})
        rows.write.mode("append").partitionBy("entity", "_ingested_day").parquet(root)
        broken = parse_messages(batch).where(is_broken()).drop("e") if seen.get["broken"] else batch.limit(0)
        if seen.get["broken"]:
            broken.write.mode("overwrite").parquet(f"{root}_rejects/batch={batch_id}")
        delivered(batch, broken, prefix).write.mode("overwrite").parquet(f"{root}_progress/batch={batch_id}")
        if after_write is not None:
            after_write(batch_id)

    return write


def delivered(batch: DataFrame, broken: DataFrame, prefix: str) -> DataFrame:
    """What a batch held of each partition: the position after its last message, messages,
    tombstones and broken ones."""
    rows = batch.select(
        "topic", "partition", "offset", F.col("value").isNull().alias("tombstone"), F.lit(False).alias("broken"),
    ).unionByName(broken.select(
        "topic", "partition", "offset", F.lit(False).alias("tombstone"), F.lit(True).alias("broken")))
    return rows.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.count_if(~F.col("broken")).alias("messages"),
        F.count_if("tombstone").alias("tombstones"), F.count_if("broken").alias("rejected")).withColumn(
        "entity", entity_of(F.col("topic"), prefix))


def run_changes(
    messages: DataFrame, root: str, checkpoint: str, prefix: str, *,
    drain: bool = True, after_write: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the consumer. ``drain`` reads what is there and stops (X2), else
    it runs until it is stopped."""
    writer = (
        messages.writeStream.foreachBatch(append_changes(root, prefix, after_write))
        .option("checkpointLocation", checkpoint))
    if drain:
        return writer.trigger(availableNow=True).start()
    # the source decides when a batch is due: enough messages, or the delay
    return writer.trigger(processingTime="1 second").start()


PROGRESS = ("topic STRING, partition INT, next_offset BIGINT, messages BIGINT, tombstones BIGINT, "
            "rejected BIGINT, entity STRING, batch BIGINT")


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """A row for every batch and partition that the consumer has written."""
    return spark.read.schema(PROGRESS).parquet(f"{root}_progress")


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """Messages, tombstones and broken messages of every batch and table."""
    return read_progress(spark, root).groupBy("batch", "entity").agg(
        *[F.sum(c).alias(c) for c in ("messages", "tombstones", "rejected")])


def consumer_positions(spark: SparkSession, root: str) -> DataFrame:
    """topic, partition, offset: where the consumer goes on reading."""
    return read_progress(spark, root).groupBy("topic", "partition").agg(F.max("next_offset").alias("offset"))


def offsets_of(progress: dict) -> list[dict]:
    """Where each partition of a finished batch stands, from the progress of a source that
    counts by topic and partition: read up to ``next_offset``, ``high`` at the broker (X8)."""
    out = []
    for source in progress["sources"]:
        maps = [source.get(k) or {} for k in ("endOffset", "latestOffset")]
        read, there = (json.loads(m) if isinstance(m, str) else m for m in maps)
        if not isinstance(read, dict) or not all(isinstance(p, dict) for p in read.values()):
            continue  # a source of files has one position, not one a partition
        for topic, partitions in sorted(read.items()):
            for partition, offset in sorted(partitions.items(), key=lambda x: int(x[0])):
                high = there.get(topic, {}).get(partition, offset)
                out.append({
                    "batch": progress["batchId"], "topic": topic, "partition": int(partition),
                    "next_offset": offset, "high": high, "lag": high - offset})
    return out


class LagTable(StreamingQueryListener):
    """Appends ``offsets_of`` every batch of the session's streams to a table of files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = offsets_of(json.loads(event.progress.json))
        if rows:  # one a partition of the topics
            self.spark.createDataFrame(
                rows, "batch BIGINT, topic STRING, partition INT, next_offset BIGINT, high BIGINT, lag BIGINT",
            ).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_changes(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The appended log of one entity; only its folder is listed and read."""
    partitions = [T.StructField("entity", T.StringType()), T.StructField("_ingested_day", T.DateType())]
    schema = T.StructType(S.CHANGE_LOG.fields + partitions)
    return spark.read.schema(schema).parquet(root).where(F.col("entity") == entity).select(
        *S.CHANGE_LOG.names)


POSITIONS = 1 << 16  # positions of one state row


def _unseen(
    key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, offset: str,
) -> Iterator[pd.DataFrame]:
    """The rows of a run of positions that came for the first time; the state keeps the
    positions seen as intervals."""
    edges = np.zeros(POSITIONS + 1, np.int8)
    if state.exists:
        low, high = np.frombuffer(state.get[0], np.int32).reshape(-1, 2).T
        edges[low], edges[high] = 1, -1
    seen = np.cumsum(edges[:-1]).astype(bool)
    for frame in frames:
        at = (frame[offset] - key[2] * POSITIONS).to_numpy()
        first = np.zeros(len(at), bool)
        first[np.unique(at, return_index=True)[1]] = True
        new = first & ~seen[at]
        seen[at] = True
        if new.any():
            yield frame[new].drop(columns="_run")
    steps = np.diff(seen.astype(np.int8), prepend=0, append=0)
    state.update((np.stack([np.flatnonzero(steps > 0), np.flatnonzero(steps < 0)], 1).astype(np.int32).tobytes(),))


def drop_redelivered_stream(changes: DataFrame, position: list[str] = DELIVERY) -> DataFrame:
    """One row per position on the stream itself (X7), however late a row comes.

    There is no watermark, which would drop late rows as well as late copies. A state row
    stands for a run of 65,536 positions of a partition and holds the intervals seen: a run
    without a gap is one interval, so state grows with gaps, not with messages. A hot
    partition is as many groups as it has runs. Positions are not null and start at 0.
    """
    topic, partition, offset = position
    run = F.shiftright(offset, POSITIONS.bit_length() - 1)
    return changes.withColumn("_run", run).groupBy(topic, partition, "_run").applyInPandasWithState(
        lambda key, frames, state: _unseen(key, frames, state, offset),
        changes.schema, "seen BINARY", "append", "NoTimeout")


def run_distinct_changes(messages: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Append every change once to ``root``. Copies go before they are parsed."""
    with_rocksdb(messages.sparkSession)
    once = drop_redelivered_stream(messages, ["topic", "partition", "offset"])
    return (
        decode_messages(once).writeStream.outputMode("append")
        .format("parquet").option("path", root).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def with_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk; queries take the setting when they start."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def latest_state_stream(changes: DataFrame) -> DataFrame:
    """Latest image per key as a running aggregate (X6): the greatest (lsn,
    offset) wins, so redelivery and reordering change nothing."""
    newest = F.struct("lsn", "_kafka_offset")
    image = row_image(F.col("op"), F.col("before"), F.col("after"))
    return changes.groupBy("_key").agg(
        F.max_by(F.struct("op", "lsn", image.alias("image")), newest).alias("row")
    ).select("_key", "row.op", "row.lsn", "row.image")


STATE = "_key STRING, op STRING, lsn BIGINT, image STRING"


def state_log(spark: SparkSession, root: str) -> UpsertLog:
    return UpsertLog(spark, root, STATE, ["_key"], [F.desc("lsn"), F.desc("op")])


def run_latest_state(
    messages: DataFrame, root: str, checkpoint: str,
) -> StreamingQuery:
    """Keep the state as upserts: each batch stores the keys it changed, full levels of
    batches are merged, and ``read_latest_state`` takes the newest row of each key.

    One row per key is kept as state, on the executors' disks (RocksDB) so that
    the number of keys is not bound by memory.
    """
    with_rocksdb(messages.sparkSession)
    log = state_log(messages.sparkSession, root)
    return (
        latest_state_stream(decode_messages(messages)).writeStream.outputMode("update")
        .foreachBatch(log.add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def read_latest_state(spark: SparkSession, root: str) -> DataFrame:
    return state_log(spark, root).read()
