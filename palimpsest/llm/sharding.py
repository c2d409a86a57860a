"""Sharding by extendible hashing.

A directory indexed by the leading bits of a row hash; only a bucket over its
byte limit is split on one more bit, until every shard fits. Bucket sizes come
from a histogram over the first LEVEL bits, whose at most 2**LEVEL rows go to all
tasks, so the texts are not shuffled. Rows of a cell that is still too large go
through the next LEVEL bits, so no bucket is capped; how those directories are
joined is left to their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import stored

BITS, LEVEL = 60, 15


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 bits of the id and the text; rows with null or repeated ids spread by their text."""
    inner = F.md5(F.coalesce(F.col(text), F.lit("")))
    whole = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), inner))
    return F.conv(F.substring(whole, 1, BITS // 4), 16, 10).cast("long")


def _prefix(value: Column, bits: Column | int, of: int) -> Column:
    """The leading ``bits`` bits of a number of ``of`` bits."""
    if isinstance(bits, int):
        return F.shiftright(value, of - bits)
    return F.call_function("shiftright", value, (F.lit(of) - bits).cast("int"))


def directory(sized: DataFrame, limit_bytes: int, used: int = 0) -> DataFrame:
    """(cell, depth, shard_bytes) over the first ``used + LEVEL`` bits of ``__hash``.

    The depth of a cell is the smallest one whose bucket fits; null if none does.
    """
    upto = used + LEVEL
    cells = stored(
        sized.groupBy(_prefix(F.col("__hash"), upto, BITS).alias("cell"))
        .agg(F.sum("__bytes").alias("bytes")), "shard-cells")
    depths = F.explode(F.sequence(F.lit(used), F.lit(upto))).alias("depth")
    levels = cells.select("cell", "bytes", depths).withColumn(
        "prefix", _prefix(F.col("cell"), F.col("depth"), upto))
    fitting = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")).filter(
        F.col("shard_bytes") <= limit_bytes)
    found = levels.drop("bytes").join(fitting, ["depth", "prefix"]).groupBy("cell").agg(
        F.min(F.struct("depth", "shard_bytes")).alias("found"))
    if upto == BITS:  # one hash value: nothing left to split on
        return cells.join(found, "cell", "left").select(
            "cell", F.coalesce("found.depth", F.lit(BITS)).alias("depth"),
            F.coalesce("found.shard_bytes", "bytes").alias("shard_bytes"))
    return cells.join(found, "cell", "left").select("cell", "found.depth", "found.shard_bytes")


def extendible_shards(
    docs: DataFrame, limit_bytes: int, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with ``row_bytes``, ``shard`` (its hash bits), ``depth``, ``shard_bytes``.

    Null and empty texts have 0 bytes and are placed by their id; repeated rows
    (same id, same text) share a hash and stay together, which is the one case,
    besides a single text over the limit, in which a shard of depth 60 exceeds
    it. An empty table gives no rows. Other columns pass through unread;
    columns named like the four new ones are replaced.
    """
    new = ["row_bytes", "shard", "depth", "shard_bytes"]
    rows = docs.drop(*(c for c in docs.columns if c.lower() in new)).withColumns({
        "__hash": row_hash(doc_id, text),
        "row_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long")})
    pending, used = rows.select("__hash", F.col("row_bytes").alias("__bytes")), 0
    out, found = rows, []
    while True:
        level = stored(directory(pending, limit_bytes, used), "shard-directory")
        names = [f"__cell{used}", f"__depth{used}", f"__total{used}"]
        found_at = level.toDF(*names)
        out = out.withColumn(names[0], _prefix(F.col("__hash"), used + LEVEL, BITS)).join(
            found_at if used else F.broadcast(found_at), names[0], "left")  # 2**LEVEL rows at most
        found.append(names)
        over = level.filter(F.col("depth").isNull()).select("cell")
        if used + LEVEL >= BITS or over.isEmpty():
            break
        pending = stored(
            pending.withColumn("cell", _prefix(F.col("__hash"), used + LEVEL, BITS))
            .join(over, "cell", "left_semi").drop("cell"), "shard-pending")
        used += LEVEL
    depth = F.coalesce(*(F.col(n[1]) for n in found))
    bits = F.lpad(F.bin(_prefix(F.col("__hash"), F.col("depth"), BITS)), 64, "0")
    return out.withColumns({
        "depth": depth.cast("int"),
        "shard_bytes": F.coalesce(*(F.col(n[2]) for n in found)),
    }).withColumn(
        "shard", F.when(F.col("depth") == 0, "").otherwise(
            F.call_function("right", bits, F.col("depth")))
    ).select(*(c for c in rows.columns if c not in ("__hash", "row_bytes")), *new)
