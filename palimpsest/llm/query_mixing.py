"""op3: documents mixed to target weights, four fifths of the corpus, at most two epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.llm.common import read
from palimpsest.llm.mixing import mixed
from palimpsest.llm.registry import query

WEIGHTS = {
    "domain": {"d0": 4, "d1": 2, "d2": 2, "d3": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 3, "src1": 2, "src2": 2},
}
EPOCHS, SEED = 2, 17


def domain() -> Column:
    """The table has no domain: sources are dealt to four by the first digit of their md5."""
    digit = F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 1)
    return F.when(digit < "4", "d0").when(digit < "8", "d1").when(digit < "c", "d2").otherwise("d3")


def _case(level: str) -> str:
    whens = " ".join(f"WHEN {level} = '{k}' THEN {w}" for k, w in WEIGHTS[level].items())
    return f"CASE {whens} ELSE 1 END"


def _level(name: str, path: str, above: str, parent: str) -> str:
    """One level of the tree: its nodes, their water level, what each is given."""
    order = f"PARTITION BY {parent or '1'} ORDER BY cap / weight, {name}"
    before = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    on = " AND ".join(f"n.{c.strip()} = a.{c.strip()}" for c in parent.split(",")) if parent else "true"
    return f"""
{name}_n AS (SELECT {path}, sum(cap)::DOUBLE AS cap, {_case(name)} AS weight FROM leaves GROUP BY {path}),
{name}_l AS (
  SELECT *, (budget - coalesce(sum(cap) {before}, 0)) /
    (sum(weight) OVER (PARTITION BY {parent or '1'}) - coalesce(sum(weight) {before}, 0)) AS level
  FROM (SELECT n.*, a.given AS budget FROM {name}_n n JOIN {above} a ON {on})),
{name}_g AS (
  SELECT *, CASE WHEN cap <= level * weight THEN cap ELSE weight *
    max(CASE WHEN cap > level * weight THEN level END) OVER (PARTITION BY {parent or '1'}) END AS given
  FROM {name}_l)"""


SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN md5(coalesce(source, '')) < '4' THEN 'd0' WHEN md5(coalesce(source, '')) < '8' THEN 'd1'
      WHEN md5(coalesce(source, '')) < 'c' THEN 'd2' ELSE 'd3' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens, {EPOCHS} * sum(n_tokens) AS cap
  FROM t GROUP BY ALL),
top AS (SELECT least(sum(cap), sum(tokens) * 4 // 5)::DOUBLE AS given FROM leaves),
{_level("domain", "domain", "top", "")},
{_level("lang", "domain, lang", "domain_g", "domain")},
{_level("source", "domain, lang, source", "lang_g", "domain, lang")},
plan AS (
  SELECT domain, lang, source,
    CASE WHEN tokens > 0 THEN floor(given / tokens) ELSE 0 END::BIGINT AS whole,
    floor(given - CASE WHEN tokens > 0 THEN floor(given / tokens) ELSE 0 END * tokens)::BIGINT AS part
  FROM source_g JOIN leaves USING (domain, lang, source))
SELECT doc_id, n_tokens, (whole + CASE WHEN sum(n_tokens) OVER (
    PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws(':', '{SEED}', whole::VARCHAR, coalesce(doc_id::VARCHAR, ''))), doc_id, n_tokens
    ROWS UNBOUNDED PRECEDING) <= part THEN 1 ELSE 0 END)::BIGINT AS copies
FROM t JOIN plan USING (domain, lang, source)
"""


@query("op3_mixing", SQL)
def op3(spark, sf_dir):
    return mixed(
        read(spark, sf_dir, "documents"), budget=F.expr("sum(tokens) * 4 div 5"), weights=WEIGHTS,
        domain=domain(), epochs=EPOCHS, seed=SEED).select("doc_id", "n_tokens", "copies")
