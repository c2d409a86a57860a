"""op11: codes of all embeddings, with the same rounds in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.llm import codes
from palimpsest.llm.common import read
from palimpsest.llm.registry import query

PARTS, ENTRIES, ROUNDS = 8, 16, 6


def sql() -> str:
    """Each round compares every part with every entry; the parts are unnested once."""
    steps = [f"""
    kept AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT vec_id, p, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS x
      FROM kept, range({PARTS}) r(p)),
    book0 AS MATERIALIZED (
      SELECT p, rank() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
      QUALIFY rank() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES})"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
    near{n} AS MATERIALIZED (
      SELECT vec_id, p, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c),
        lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := e)) AS best
      FROM parts JOIN book{n} USING (p) GROUP BY vec_id, p, x)""")
        if n < ROUNDS:
            steps.append(f"""
    mean{n} AS (
      SELECT p, e, list(m ORDER BY i) AS c FROM (
        SELECT p, best.e AS e, i, floor(sum(x[i + 1])::DOUBLE / count(*))::BIGINT AS m
        FROM near{n}, range(len(x)) r(i) GROUP BY ALL) GROUP BY p, e),
    book{n + 1} AS MATERIALIZED (
      SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (p, e))""")
    return f"""
    WITH {",".join(steps)},
    coded AS (
      SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
      FROM near{ROUNDS} GROUP BY vec_id),
    digest AS (
      SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book{ROUNDS})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
      s AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest"""


@query("op11_vector_codes", sql())
def op11(spark, sf_dir):
    coded, books = codes.compressed(read(spark, sf_dir, "embeddings"), parts=PARTS, entries=ENTRIES, rounds=ROUNDS)
    return codes.by_label(coded).select(
        "vec_id", F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))
