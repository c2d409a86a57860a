"""op7: line-first quality rules over all documents."""

from __future__ import annotations

from palimpsest.llm import quality as Q
from palimpsest.llm.common import read
from palimpsest.llm.registry import query

LINE_FAILS = f"""
  NOT regexp_matches(l, '{Q.PUNCTUATION}')
  OR (length(regexp_replace(l, '{Q.SYMBOLS}', '', 'g')) + length(l) - length(replace(l, '!!', ''))) * 100
    > length(l) * {Q.MAX_SYMBOLS}
  OR (length(regexp_replace(l, '{Q.SEPARATORS}', '', 'g')) >= 3
    AND length(regexp_replace(l, '{Q.SEPARATORS}', '', 'g')) * 40 >= length(l))
  OR regexp_matches(lower(l), '{Q.MENU.replace(chr(92) * 2, chr(92))}')
  OR (length(l) <= {Q.BOILERPLATE_CHARS} AND regexp_matches(lower(l), '{Q.BOILERPLATE}'))"""
SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
x AS (
  SELECT rid, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS x
  FROM t WHERE len(w) >= 3),
c AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n
  FROM (SELECT rid, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM x)),
r AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM c, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY rid),
b AS (
  SELECT t.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '{Q.SYMBOLS}', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(array_to_string(ls, '')) AS line_chars,
    length(array_to_string(list_distinct(list_filter(ls, lambda l: NOT ({LINE_FAILS}))), '')) AS kept_chars
  FROM t LEFT JOIN r USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEATED} * n_words)
    AND 100 * coalesce(kept_chars, 0) >= {Q.KEPT} * coalesce(line_chars, 0) AS kept
FROM b
"""


@query("op7_quality_rules", SQL)
def op7(spark, sf_dir):
    return Q.judged(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *Q.BASE, "base_failed", "kept")
