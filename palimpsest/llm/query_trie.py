"""op12: the prefix trie of all conversations."""

from __future__ import annotations

from palimpsest.llm import trie
from palimpsest.llm.common import read
from palimpsest.llm.registry import query

# A node is the md5 of its turns in order; h = crc32 of the id is found bit by bit, as the
# engine has no function for it: one row an id and byte.
SQL = r"""
WITH RECURSIVE bits AS MATERIALIZED (
  SELECT i AS byte, list_reduce(range(8)::BIGINT[], lambda c, n: CASE WHEN c % 2 = 1
    THEN xor(c // 2, 3988292384) ELSE c // 2 END, i::BIGINT) AS v FROM range(256) r(i)),
ids AS MATERIALIZED (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT conv_id, 0 AS nth, 4294967295::BIGINT AS c FROM ids
  UNION ALL
  SELECT conv_id, nth + 1, xor(c // 256, v) FROM crc JOIN bits
    ON byte = xor(c % 256, ascii(substr(conv_id::VARCHAR, nth + 1, 1)))
  WHERE nth < length(conv_id::VARCHAR)),
heads AS MATERIALIZED (
  SELECT conv_id, (3 - c % 4)::BIGINT AS h FROM crc WHERE nth = length(conv_id::VARCHAR)),
t AS MATERIALIZED (
  SELECT conv_id, m, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) - 1 AS pos
  FROM (SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS m,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
    FROM conversations WHERE conv_id IS NOT NULL)),
rebuilt AS MATERIALIZED (
  SELECT conv_id, m, w, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d FROM (
    SELECT heads.conv_id, 0 AS own, pos, m, w FROM heads
      JOIN t ON t.conv_id = heads.conv_id - heads.conv_id % 20 AND pos < h
    UNION ALL SELECT t.conv_id, 1, pos, m, w FROM t JOIN heads USING (conv_id) WHERE pos >= h)),
paths AS MATERIALIZED (
  SELECT conv_id, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS up, 0 AS w FROM ids
  UNION ALL SELECT conv_id, d, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY d), ''), w FROM (
    SELECT *, md5(string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM rebuilt)),
depth AS (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id),
ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS s
  FROM paths JOIN depth USING (conv_id, d) GROUP BY node),
nodes AS MATERIALIZED (
  SELECT node, any_value(up) AS up, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w
  FROM paths GROUP BY node),
children AS (SELECT up AS node, count(*) AS n FROM nodes GROUP BY up),
under AS (
  SELECT DISTINCT x.node AS node, y.node AS below FROM paths x JOIN paths y
    ON x.conv_id = y.conv_id AND x.d <= y.d),
totals AS (
  SELECT u.node, count(*) FILTER (c.n IS NULL) AS leaves, sum((b.n - 1) * b.w) AS saved
  FROM under u JOIN nodes b ON b.node = u.below LEFT JOIN children c ON c.node = u.below GROUP BY u.node)
SELECT nodes.conv_id, nodes.d AS depth, p.conv_id AS parent_conv_id, nodes.n AS n_convs,
  coalesce(c.n, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  coalesce(s, sha256('')) AS ends_sha256
FROM nodes JOIN totals USING (node) LEFT JOIN nodes p ON p.node = nodes.up
  LEFT JOIN children c ON c.node = nodes.node LEFT JOIN ends e ON e.node = nodes.node
"""


@query("op12_prefix_trie", SQL)
def op12(spark, sf_dir):
    return trie.conversation_trie(read(spark, sf_dir, "conversations"))
