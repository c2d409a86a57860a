"""op4: every page as a WARC record, read back from the archives."""

from __future__ import annotations

from palimpsest.llm import warc
from palimpsest.llm.common import read
from palimpsest.llm.registry import query

# DuckDB has no base32: the 160 bits of the digest are cut into 32 groups of five.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT hex, string_agg(substr('{BASE32}', 1 + (
      (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1), ''
      ORDER BY i) AS payload_digest
  FROM (SELECT DISTINCT hex FROM p), (SELECT unnest(range(32)) AS i) GROUP BY hex)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN m IS NULL OR page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN m IS NULL OR page_id = m THEN NULL ELSE m END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY hex) AS m FROM p) JOIN b USING (hex)
"""


@query("op4_warc", SQL)
def op4(spark, sf_dir):
    folder = warc.archive_folder(spark)
    warc.write_archives(read(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
