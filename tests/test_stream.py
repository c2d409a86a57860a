"""Streams: at-least-once delivery, tombstones, redelivery, running state."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from palimpsest import schemas as S
from palimpsest.operators.compare import fingerprint
from palimpsest.plans import changes as C
from palimpsest.session import work_dir
from catalog import testdata as D
from palimpsest.sources.publish import Folder
from palimpsest.streaming import changes as X
from palimpsest.streaming.upserts import UpsertLog


@pytest.fixture(scope="module")
def messages(spark, frames):
    """Messages of the busy log as files, in an order unlike the log's."""
    path = f"{work_dir(spark, 'topics')}/messages"
    log = frames.event_log.where("tx_id < 400")
    D.change_messages(log).repartition(3, "offset").write.json(path)
    return path, log


def consume(spark, path, root, **options):
    stream = X.file_messages(spark, path)
    query = X.run_changes(stream, f"{root}/log", f"{root}/cp", D.TOPIC_PREFIX, **options)
    query.awaitTermination()
    return query


def test_counts_of_every_batch(spark, messages):
    path, log = messages
    root = work_dir(spark, "counts")
    consume(spark, path, root)
    counts = X.batch_counts(spark, f"{root}/log").where("entity = 'bookings'").collect()
    deletes = log.where("op = 'd'").count()
    assert len(counts) == 3
    assert sum(c.tombstones for c in counts) == deletes
    assert sum(c.messages for c in counts) == log.count() + deletes
    assert X.read_changes(spark, f"{root}/log", "bookings").count() == log.count()


def test_crash_between_write_and_commit_repeats_but_loses_nothing(spark, messages):
    path, log = messages
    root = work_dir(spark, "crash")

    def crash(batch_id):
        if batch_id == 1:
            raise RuntimeError("simulated crash")

    with pytest.raises(StreamingQueryException):
        consume(spark, path, root, after_write=crash)
    consume(spark, path, root)
    stored = X.read_changes(spark, f"{root}/log", "bookings")
    assert stored.count() > log.count()
    positions = stored.select(*C.DELIVERY).distinct().count()
    assert positions == log.select("tx_id").distinct().count()
    assert fingerprint(C.booking_state(stored)).first() == fingerprint(
        C.booking_state(log)).first()


def test_second_run_starts_where_the_first_stopped(spark, messages):
    path, log = messages
    root = work_dir(spark, "resume")
    consume(spark, path, root)
    consume(spark, path, root)
    assert X.read_changes(spark, f"{root}/log", "bookings").count() == log.count()


def test_entities_go_to_their_own_folder(spark, frames):
    root = work_dir(spark, "routes")
    both = D.change_messages(frames.customer_log.where("tx_id < 80")).unionByName(
        D.change_messages(frames.event_log.where("tx_id < 50")))
    both.write.json(f"{root}/messages")
    consume(spark, f"{root}/messages", root)
    count = lambda e: X.read_changes(spark, f"{root}/log", e).count()
    assert count("customers") == frames.customer_log.where("tx_id < 80").count() > 0
    assert count("bookings") == frames.event_log.where("tx_id < 50").count() > 0


def test_running_state_ignores_order_and_copies(spark, messages):
    path, log = messages
    root = work_dir(spark, "state")
    X.run_latest_state(
        X.file_messages(spark, path), f"{root}/state", f"{root}/cp").awaitTermination()
    state = X.read_latest_state(spark, f"{root}/state")
    expected = C.booking_state(log).select(
        F.col("booking_id").cast("string").alias("_key"), F.col("last_op").alias("op"),
        F.col("last_lsn").alias("lsn"))
    got = state.select("_key", "op", "lsn")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_stream_dedup(spark, messages):
    path, log = messages
    root = work_dir(spark, "dedup")
    X.run_distinct_changes(
        X.file_messages(spark, path), f"{root}/out", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == log.select("tx_id").distinct().count()


def test_kafka_options():
    options = X.kafka_options("broker:9092", ["a", "b"])
    assert options["startingOffsets"] == "earliest"
    assert options["minOffsetsPerTrigger"] == "1000" and options["maxTriggerDelay"] == "300s"
    assert int(options["maxOffsetsPerTrigger"]) > 1000
    assert options["subscribe"] == "a,b"


def test_broken_messages_are_kept_aside(spark):
    root = work_dir(spark, "broken")
    good = '{"op":"c","source":{"lsn":5,"ts_ms":1000},"ts_ms":2000,"before":null,"after":{"booking_id":1}}'
    rows = [("app.public.bookings", 0, n, "k", v) for n, v in enumerate(
        [good, good[:-5], "", "null", '{"op":null,"source":{"lsn":1}}', '{"op":"u","source":{}}', None])]
    spark.createDataFrame(rows, S.MESSAGE).coalesce(1).write.json(f"{root}/in")
    query = X.run_changes(X.file_messages(spark, f"{root}/in"), f"{root}/log", f"{root}/cp", "app.public.")
    query.awaitTermination()
    (counts,) = X.batch_counts(spark, f"{root}/log").collect()
    assert (counts.messages, counts.tombstones, counts.rejected) == (7, 1, 5)
    log = X.read_changes(spark, f"{root}/log", "bookings")
    assert [r._kafka_offset for r in log.collect()] == [0]
    assert C.booking_state(log).where("booking_id IS NULL").isEmpty()
    assert sorted(r.offset for r in spark.read.parquet(f"{root}/log_rejects").collect()) == [1, 2, 3, 4, 5]


def test_state_grows_with_gaps_not_with_messages(spark):
    """Three deliveries of 40,000 contiguous positions, shuffled: one interval, one state row a partition."""
    root = work_dir(spark, "intervals")
    rows = spark.range(40_000).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
        F.floor(F.col("id") / 2).alias("offset"), F.lit("k").alias("key"), F.col("id").cast("string").alias("value"))
    for n in range(3):
        rows.orderBy(F.xxhash64("value", F.lit(n))).repartition(2).write.mode("append").json(f"{root}/in")
    X.with_rocksdb(spark)
    stream = X.drop_redelivered_stream(X.file_messages(spark, f"{root}/in", 2), ["topic", "partition", "offset"])
    query = stream.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 40_000 and out.exceptAll(rows).isEmpty()
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert state[-1] == 2 and len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_positions_with_gaps_over_run_borders(spark, monkeypatch):
    root, size = work_dir(spark, "gaps"), X.POSITIONS
    wanted = [0, 1, 5, size - 1, size, size + 1, 3 * size, 7 * size - 2, 7 * size - 1]
    for batch in (wanted[::2], wanted, wanted[::-1] + wanted[:3]):
        spark.createDataFrame(
            [("t", 0, o, "k", str(o)) for o in batch], S.MESSAGE).coalesce(1).write.mode("append").json(f"{root}/in")
    stream = X.drop_redelivered_stream(X.file_messages(spark, f"{root}/in"), ["topic", "partition", "offset"])
    stream.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.offset for r in spark.read.parquet(f"{root}/out").collect()) == wanted


def test_rejects_of_a_replayed_batch_are_stored_once(spark):
    root = work_dir(spark, "replayed")
    spark.createDataFrame([("app.public.bookings", 0, n, "k", "{") for n in range(4)], S.MESSAGE).coalesce(
        1).write.json(f"{root}/in")

    def crash(_):
        raise RuntimeError("simulated crash")

    with pytest.raises(StreamingQueryException):
        consume(spark, f"{root}/in", root, after_write=crash)
    consume(spark, f"{root}/in", root)
    assert sorted(r.offset for r in spark.read.parquet(f"{root}/log_rejects").collect()) == [0, 1, 2, 3]
    (counts,) = X.batch_counts(spark, f"{root}/log").collect()
    assert (counts.messages, counts.rejected) == (4, 4)
    (at,) = X.consumer_positions(spark, f"{root}/log").collect()
    assert (at.partition, at.offset) == (0, 4)


KAFKA = {"batchId": 7, "sources": [
    {"description": "KafkaV2[Subscribe[a,b]]", "startOffset": {"a": {"0": 1}},
     "endOffset": {"a": {"0": 5, "1": 9}, "b": {"10": 3, "2": 0}},
     "latestOffset": {"a": {"0": 5, "1": 12}, "b": {"10": 4, "2": 0}}},
    {"description": "FileStreamSource", "startOffset": None, "endOffset": {"logOffset": 1}, "latestOffset": None}]}


def test_lag_from_the_progress_of_a_partitioned_source():
    rows = X.offsets_of(KAFKA)
    assert [(r["topic"], r["partition"], r["next_offset"], r["high"], r["lag"]) for r in rows] == [
        ("a", 0, 5, 5, 0), ("a", 1, 9, 12, 3), ("b", 2, 0, 0, 0), ("b", 10, 3, 4, 1)]
    assert all(r["batch"] == 7 for r in rows)


def test_lag_table_keeps_every_batch(spark):
    import json
    from types import SimpleNamespace

    path = work_dir(spark, "lag")
    table = X.LagTable(spark, path)
    for batch in (7, 8):
        text = json.dumps({**KAFKA, "batchId": batch})
        table.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=text)))
    table.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(json=json.dumps({"batchId": 9, "sources": []}))))
    assert [(r.batch, r.lag) for r in spark.read.parquet(path).groupBy("batch").agg(
        F.sum("lag").alias("lag")).orderBy("batch").collect()] == [(7, 4), (8, 4)]


# ---- upserts by level

def upserts(spark, root, **options):
    return UpsertLog(spark, root, "k STRING, v BIGINT, note STRING", ["k"], [F.desc("v")], **options)


def batches(spark, n):
    """Batch b changes keys b, b/2, b/3 ...: old keys come back now and then."""
    for b in range(n):
        keys = sorted({b // d for d in range(1, 5)})
        yield b, spark.createDataFrame([(str(k), b, f"batch {b}") for k in keys], "k STRING, v BIGINT, note STRING")


def wanted(n):
    return {str(b // d): b for b in range(n) for d in range(1, 5)}


def test_reads_open_few_folders_however_many_batches(spark):
    log = upserts(spark, work_dir(spark, "levels"), fanout=3)
    assert log.read().count() == 0
    for b, df in batches(spark, 28):
        log.add(df, b)
    assert {r.k: r.v for r in log.read().collect()} == wanted(28)
    assert [len(level) for level in log.levels()] == [1, 0, 0, 1]  # 28 in base 3, the lowest digit first
    there = [n for n in Folder(spark, log.root).names() if n[0] not in "._"]
    assert sorted(there) == sorted(log.folders())  # what was merged is gone


@pytest.mark.parametrize("step", ["written", "added", "merged", "published"])
def test_a_crash_while_merging_loses_nothing(spark, step):
    log, crashed = upserts(spark, work_dir(spark, "crash"), fanout=3), []
    for b, df in batches(spark, 9):
        def crash(done, b=b):
            if done == step and b in (2, 5, 8) and b not in crashed:
                crashed.append(b)
                raise RuntimeError(done)

        try:
            log.add(df, b, after=crash)
        except RuntimeError:
            assert {r.k: r.v for r in log.read().collect()} == (wanted(b) if step == "written" else wanted(b + 1))
            log.add(df, b)  # the stream plays the batch again
    assert 2 in crashed and {r.k: r.v for r in log.read().collect()} == wanted(9)


def test_a_replayed_batch_replaces_its_own_folder(spark):
    log = upserts(spark, work_dir(spark, "again"))
    (first, df), = batches(spark, 1)
    log.add(df.unionByName(spark.createDataFrame([("half", 0, "x")], df.schema)), first)
    log.add(df, first)
    assert [r.k for r in log.read().collect()] == ["0"] and len(log.folders()) == 1
