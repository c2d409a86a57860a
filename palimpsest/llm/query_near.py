"""op8: near-duplicate groups of all documents."""

from __future__ import annotations

from palimpsest.llm import near
from palimpsest.llm.common import read
from palimpsest.llm.registry import query

SQL = f"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM t WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= {near.PERCENT} * (x.n + y.n - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (
  SELECT doc_id AS id, doc_id AS comp FROM t
  UNION SELECT e.b, r.comp FROM r JOIN e ON e.a = r.id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, t.doc_id = c.component_id AS kept
FROM t LEFT JOIN n USING (doc_id)
  JOIN (SELECT id, min(comp) AS component_id FROM r GROUP BY id) c ON c.id = t.doc_id
"""


@query("op8_near_duplicates", SQL)
def op8(spark, sf_dir):
    return near.near_duplicates(read(spark, sf_dir, "documents"), percent=near.PERCENT)
