"""op6: documents in shards of at most SHARD_BYTES of text."""

from __future__ import annotations

from palimpsest.llm.common import read
from palimpsest.llm.registry import query
from palimpsest.llm.sharding import extendible_shards

SHARD_BYTES = 16 << 20


def sql(limit: int, table: str = "documents") -> str:
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) AS row_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM {table}),
b AS (
  SELECT depth, h >> (60 - depth) AS prefix, sum(row_bytes) AS total
  FROM d, (SELECT unnest(range(61))::BIGINT AS depth) GROUP BY 1, 2),
s AS (
  SELECT rid, coalesce(min(depth) FILTER (total <= {limit}), 60) AS depth
  FROM d JOIN b ON h >> (60 - b.depth) = prefix GROUP BY rid)
SELECT doc_id, row_bytes::BIGINT AS row_bytes,
  CASE WHEN s.depth = 0 THEN '' ELSE right(lpad(bin(h >> (60 - s.depth)), 64, '0'), s.depth::INT) END AS shard,
  s.depth::INTEGER AS depth, total::BIGINT AS shard_bytes
FROM d JOIN s USING (rid) JOIN b ON b.depth = s.depth AND b.prefix = h >> (60 - s.depth)
"""


@query("op6_sharding", sql(SHARD_BYTES))
def op6(spark, sf_dir):
    shards = extendible_shards(read(spark, sf_dir, "documents"), SHARD_BYTES)
    return shards.select("doc_id", "row_bytes", "shard", "depth", "shard_bytes")
