"""Deterministic sharded WARC archives: writer and reader.

Pages are range-sorted by id into shards of bounded bytes. The bounds come from
a running sum of payload bytes over all ids in order, so they do not depend on
how Spark cut its partitions. A task writes a shard's records, one gzip member
each, and starts a new file when the compressed size passes ``roll_bytes``.
Files are written under temporary names of their attempt, listed in a table,
renamed, and committed by the manifest: a lost or repeated task leaves only
files that no manifest names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import stored
from palimpsest.session import work_dir

MAX_SHARDS = 1 << 20  # bound of the list of shard starts, 8 MB
FILES = pa.schema([
    ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()),
    ("bytes", pa.int64()), ("sha256", pa.string())])
RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())])


def spark_type(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary",
             pa.float64(): "double", pa.int32(): "int", pa.bool_(): "boolean"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def record_id(page_id, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest.hex()}')}>"


def record(page_id, url, payload: bytes, digest: bytes, first, date: str) -> bytes:
    """One WARC record; ``first`` is the page whose response a revisit points to."""
    sha1 = base64.b32encode(digest).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = first is not None
    block = http if revisit else http + payload
    block_sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
        ("WARC-Target-URI", url and re.sub(
            r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{sha1}"), ("WARC-Block-Digest", f"sha1:{block_sha1}"),
        ("WARC-Profile", revisit and
         "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", revisit and record_id(first, digest)),
        ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", first),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None and v is not False)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def shard_starts(narrow: DataFrame, shard_bytes: int) -> np.ndarray:
    """The smallest id of each shard, from the running sum of bytes in id order."""
    ids = narrow.groupBy("page_id").agg(F.sum("bytes").alias("bytes")).filter("page_id is not null")
    ranged = stored(
        ids.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "warc-ranges")
    totals = ranged.groupBy("part").agg(F.sum("bytes").alias("total"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("skip"))
    run = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    total = ranged.agg(F.sum("bytes")).head()[0] or 0
    size = max(shard_bytes, -(-total // MAX_SHARDS))
    upto = F.col("skip") + F.coalesce(F.sum("bytes").over(run), F.lit(0))
    starts = ranged.join(offsets, "part").select(
        "page_id", F.floor(upto / size).alias("shard")).groupBy("shard").agg(
        F.min("page_id").alias("start"))
    return np.sort(np.array([r.start for r in starts.select("start").collect()], np.int64))


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int = 16 << 20, roll_bytes: int = 4 << 20,
    date: str = "2000-01-01T00:00:00Z", level: int = 6,
) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) in ``folder``; returns their manifest.

    A null html is an empty payload. Of equal payloads, empty ones included, the
    smallest page_id is written as response and the others as revisits of it;
    rows repeated with that same id are responses too. Null ids are revisits
    where an id has the payload, else responses, and go to the first shard. A
    null url has no target line. Control characters and blanks of a url are
    percent-encoded. Other columns are not archived. An empty table gives an
    empty manifest. Ids should be nearly unique: equal ids share a shard.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    narrow = stored(rows.select(
        "page_id", F.unhex(F.sha1(F.encode("html", "utf-8"))).alias("sha1"),
        F.octet_length("html").cast("long").alias("bytes")), "warc-digests")
    firsts = narrow.groupBy("sha1").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    starts = shard_starts(narrow, shard_bytes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("page_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            shard = np.maximum(np.searchsorted(starts, ids, "right") - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(shard, pa.int64())], names=[*b.schema.names, "shard"])

    def write(key, texts: pa.Table, plan: pa.Table) -> pa.Table:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(f"{base}/_temporary", recursive=True)
        seen = dict(zip(
            zip(plan["page_id"].to_pylist(), plan["sha1"].to_pylist()), plan["first"].to_pylist()))
        html = texts["html"].combine_chunks()
        order = sorted(
            ((-1 if p is None else 0, p or 0, hashlib.sha1(h.as_buffer()).digest(), i)
             for i, (p, h) in enumerate(zip(texts["page_id"].to_pylist(), html))))
        urls, ids = texts["url"].to_pylist(), texts["page_id"].to_pylist()
        attempt, made, buffer, n, size = uuid.uuid4().hex, [], [], 0, 0

        def roll() -> None:
            nonlocal buffer, n, size
            name = f"part-{key[0].as_py():07d}-{len(made):04d}.warc.gz"
            body = b"".join(buffer)
            with system.open_output_stream(
                    f"{base}/_temporary/{attempt}-{name}", compression=None) as out:
                out.write(body)
            made.append((f"_temporary/{attempt}-{name}", name, n, len(body),
                         hashlib.sha256(body).hexdigest()))
            buffer, n, size = [], 0, 0

        for _, _, digest, i in order:
            packer = zlib.compressobj(level, wbits=31)
            first = seen.get((ids[i], digest))
            first = None if first == ids[i] else first
            member = packer.compress(
                record(ids[i], urls[i], html[i].as_buffer().to_pybytes(), digest, first, date))
            member += packer.flush()
            if n and size + len(member) > roll_bytes:
                roll()
            buffer.append(member)
            n, size = n + 1, size + len(member)
        if n:
            roll()
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*made) if made else [[]] * 5, FILES)],
            schema=FILES)

    placed = rows.mapInArrow(place, "page_id long, url string, html string, shard long")
    plan = narrow.join(firsts, "sha1", "left").select("page_id", "sha1", "first").mapInArrow(
        place, "page_id long, sha1 binary, first long, shard long")
    files = stored(
        placed.groupBy("shard").cogroup(plan.groupBy("shard")).applyInArrow(
            write, spark_type(FILES)), "warc-files")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for old, new in zip(b.column("temporary").to_pylist(), b.column("name").to_pylist()):
                if system.get_file_info(f"{base}/{old}").type == fs.FileType.File:
                    system.move(f"{base}/{old}", f"{base}/{new}")
            yield b.drop_columns(["temporary"])

    names = pa.schema([f for f in FILES if f.name != "temporary"])
    path = f"{folder}/manifest"
    files.mapInArrow(rename, spark_type(names)).write.parquet(path)
    return spark.read.schema(spark_type(names)).parquet(path)


def members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a stream."""
    unpack, content, at, start, rest = zlib.decompressobj(31), [], 0, 0, b""
    while chunk := rest or stream.read(1 << 20):
        content.append(unpack.decompress(chunk))
        rest = unpack.unused_data
        at += len(chunk) - len(rest)
        if unpack.eof:
            yield start, b"".join(content)
            unpack, content, start = zlib.decompressobj(31), [], at
    if content and any(content):
        raise ValueError(f"the archive ends inside the record at {start}")


def parse(raw: bytes) -> dict:
    """Fields of a record, with its payload; raises if a digest does not fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    wanted = [(block, fields["WARC-Block-Digest"].removeprefix("sha1:"))]
    if fields["WARC-Type"] == "response":
        wanted.append((payload, digest))
    for content, sha1 in wanted:
        if base64.b32encode(hashlib.sha1(content).digest()).decode() != sha1:
            raise ValueError(f"a digest of {fields['WARC-Record-ID']} does not fit")
    return {
        "page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"),
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": digest,
        "payload": payload if fields["WARC-Type"] == "response" else None}


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of the files that the manifest of ``folder`` names.

    Digests and sizes are checked on the way; ``payload`` is null for revisits,
    and for all records if not asked for.
    """
    files = spark.read.parquet(f"{folder}/manifest")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name, n in zip(b.column("name").to_pylist(), b.column("records").to_pylist()):
                found, held, count = [], 0, 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for at, raw in members(stream):
                        row = parse(raw) | {"file": name, "offset": at}
                        if not payload:
                            row["payload"] = None
                        found.append(row)
                        count, held = count + 1, held + len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, RECORDS)
                            found, held = [], 0
                if count != n:
                    raise ValueError(f"{name} has {count} records, its manifest {n}")
                if found:
                    yield pa.RecordBatch.from_pylist(found, RECORDS)

    wanted = max(1, min(files.count(), 100_000))
    return files.select("name", "records").repartition(wanted, "name").mapInArrow(
        scan, spark_type(RECORDS))


def archive_folder(spark: SparkSession) -> str:
    return work_dir(spark, "warc")


